"""Hot groups, plans and exactness of the distributed building blocks."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from larder.functions import quantiles
from larder.functions.quantiles import exact_quantiles
from larder.functions.running import running_total
from larder.operators import demand, evaluate, forecast, quality, ridge, series
from larder.plans.catalog import QUERIES
from larder.sources import sample_tables
from larder.sources.sample_tables import movements


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("bits", [1, 8, 20])
def test_running_total_of_a_hot_group(spark, bits):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({
        "g": np.where(rng.random(n) < 0.7, "hot", "cold"), "d": rng.integers(0, 20, n),
        "k": rng.permutation(n), "v": rng.integers(-5, 9, n).astype(float),
    })
    df = running_total(
        spark.createDataFrame(pdf), ["g"], "d", F.shiftright("k", bits), ["k"], "v", "total").toPandas()
    pdf = pdf.sort_values(["g", "d", "k"])
    pdf["expected"] = pdf.groupby("g").v.cumsum()
    both = df.merge(pdf[["k", "expected"]], on="k")
    assert len(both) == n and (both.total == both.expected).all()


def test_running_total_keeps_rows_without_a_group(spark):
    df = spark.createDataFrame([("a", 1, 1, 2.0), (None, 1, 2, 3.0)], "g string, d int, k int, v double")
    assert sorted(r["total"] or -1 for r in running_total(df, ["g"], "d", F.col("k"), ["k"], "v", "total").collect()) == [-1, 2.0]


def test_stock_of_hot_days_is_the_same(spark, sf, monkeypatch):
    columns = ["nom_produit", "date", "type_operation", "id_lot", "id_produit", "quantite", "stock_theorique"]
    usual = sorted(map(str, movements(spark, sf, *columns).collect()))
    monkeypatch.setattr(sample_tables, "LOT_BLOCK_BITS", 3)
    assert sorted(map(str, movements(spark, sf, *columns).collect())) == usual


def known_of(pdf):
    return {c: (int(v.count()), float(v.min()), float(v.max())) if v.count() else (0, None, None) for c, v in pdf.items()}


def test_exact_quantiles(spark):
    rng = np.random.default_rng(1)
    n = 30_000
    pdf = pd.DataFrame({
        "normal": rng.normal(size=n), "codes": rng.integers(0, 3, n).astype(float), "hot": np.where(rng.random(n) < 0.4, 5.0, rng.random(n) * 10),
        "wide": rng.choice([-1e300, -1.0, 0.0, 5e-324, 1.0, 1e300], n), "tiny": 1.0 + rng.integers(0, 5, n) * 2.0**-52, "none": np.full(n, np.nan),
    })
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = exact_quantiles(df, list(pdf), probs, known_of(pdf))
    assert found.pop("none") == [None] * 5
    for c, values in found.items():
        np.testing.assert_allclose(values, pdf[c].quantile(probs).to_numpy(), rtol=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_quantiles_of_few_values(spark, n):
    pdf = pd.DataFrame({"x": [float(i * i) for i in range(n)]})
    assert exact_quantiles(spark.createDataFrame(pdf), ["x"], [0.25, 0.5], known_of(pdf))["x"] == pdf.x.quantile([0.25, 0.5]).tolist()


def test_quantiles_take_few_passes(spark, monkeypatch):
    passes = []
    counted = quantiles._counts
    monkeypatch.setattr(quantiles, "_counts", lambda df, ranges: passes.append(len(ranges)) or counted(df, ranges))
    df = spark.range(200_000).select((F.col("id") * 1.0).alias("x"))
    assert exact_quantiles(df, ["x"], [0.5], {"x": (200_000, 0.0, 199_999.0)})["x"] == [99_999.5]
    assert len(passes) <= 3 and max(passes) <= 2


def test_quantiles_of_infinite_values(spark):
    df = spark.createDataFrame([(float(x),) for x in ["-inf", "-inf", *range(9), "inf", "inf"]] + [(None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.25, 0.5, 0.75], {"x": (13, float("-inf"), float("inf"))})["x"] == [1.0, 4.0, 7.0]


def test_quantile_passes_shuffle_bins_not_values(spark):
    df = spark.range(0, 100_000, 1, 2).select((F.col("id") * 1.0).alias("x"), (F.col("id") % 3).alias("y"))
    counted = quantiles._counted(df, [quantiles._Range("x", 0.0, 99_999.0, 0, [5]), quantiles._Range("y", 0.0, 2.0, 0, [5])])
    found = counted.collect()
    assert len(found) == 1024 + 3 and {sum(r.nb for r in found if r.plage == i) for i in (0, 1)} == {100_000}
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_describe_equals_pandas(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({f"c{i}": rng.integers(-50, 50, 900) / (i + 1) for i in range(14)})
    pdf.loc[::7, "c3"] = np.nan
    pdf["vide"] = np.nan
    found = {r["colonne"]: r for r in quality.describe(spark.createDataFrame(pdf).withColumn("entier", F.lit(2))).collect()}
    assert list(found) == [*pdf, "entier"] and found["vide"][1:] == (0, *[None] * 7) and found["entier"][1:] == (900, 2.0, 0.0, *[2.0] * 5)
    for c in pdf.drop(columns="vide"):
        np.testing.assert_allclose(found[c][1:], pdf[c].describe().to_numpy(), rtol=1e-12, atol=1e-12)


def test_describe_takes_one_aggregate_per_measure(spark, make):
    """One aggregate per measure, whatever the number of columns."""
    plans = []
    listened = type(spark.range(1)).collect

    def collect(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return listened(df)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.range(1)), "collect", collect)
        quality.describe(make({}, {"quantite": 2.0}))
    assert plans[0].count("stddev_samp(") == 1


def test_stock_shuffles_plain_columns(spark, sf):
    """Columns that derive from others are worked out above the shuffle of the running stock."""
    plan = movements(spark, sf)._jdf.queryExecution().executedPlan().toString()
    for name in ("type_produit", "type_sortie", "unite", "date_expiration"):
        assert plan.index(f" AS {name}") < plan.index("Exchange hashpartitioning")


@pytest.mark.parametrize("name, exchanges, sorts", [("profile_shape", 1, 0), ("operation_shares", 2, 1), ("schema_check", 0, 0)])
def test_exchanges_and_sorts(spark, sf, name, exchanges, sorts):
    plan = final_plan(QUERIES[name](spark, sf))
    plan = plan.split("Subqueries")[0]
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition") <= exchanges
    assert plan.count("Sort [") <= sorts


def test_hot_product_and_hot_day(spark, make):
    """A third of all rows on one product and day stays correct and is combined before the shuffle."""
    mv = make({}, {"nom_produit": "lait"}).withColumn("k", F.explode(F.sequence(F.lit(1), F.when(F.col("nom_produit") == "riz", 5000).otherwise(10))))
    daily = demand.daily_demand(demand.consumed(mv))
    assert {r["nom_produit"]: r["quantite"] for r in daily.collect()} == {"riz": 5000.0, "lait": 10.0}
    assert "partial_sum" in final_plan(daily)


def test_series_and_forecast_share_one_product_shuffle(spark, sf):
    daily = demand.daily_demand(demand.consumed(movements(spark, sf, "nom_produit", "date", "type_sortie", "quantite")))
    split = series.with_split(series.dense_daily(daily), days=365)
    scores = evaluate.ranked(evaluate.metrics(forecast.backtest_both(split), ["nom_produit", "modele"]))
    plan = final_plan(scores)
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Python" not in plan and "InPandas" not in plan


def test_regression_reads_the_table_once(spark, sf):
    plan = final_plan(QUERIES["forecast_28d"](spark, sf))
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("FlatMapGroupsInArrow") == 1


@pytest.mark.parametrize("name", ["order_recommendation", "product_summary", "forecast_28d", "model_comparison", "scan_movements"])
def test_no_cross_joins_and_no_window_over_everything(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for line in plan.splitlines():
        if "windowspecdefinition(" in line:
            first = line.split("windowspecdefinition(")[1]
            assert not first.startswith("specifiedwindowframe") and " ASC" not in first.split(",")[0]


def test_fourier_terms_match_the_solver(spark):
    from larder.functions import solver

    days = spark.createDataFrame([("2024-02-29",), ("1999-12-31",)], "d string").select(F.col("d").cast("date").alias("ds"))
    found = series.fourier_features(days).orderBy("ds").toPandas()
    number = np.array([10956.0, 19782.0])
    expected = np.hstack([solver._waves(number, 20, 365.25), solver._waves(number, 5, 7.0)])
    np.testing.assert_allclose(found.drop(columns="ds").to_numpy(), expected, atol=1e-9)


def test_model_rows_blind_zeroes_only_test_days(spark, sf):
    dense = series.dense_daily_regressors(demand.daily_demand(demand.consumed(movements(spark, sf)), regressors=True))
    rows = ridge.backtest_rows(dense, [], blind=True)
    assert rows.where(~F.col("appris") & (F.get("regresseurs", F.lit(0)) != 0)).count() == 0
    assert rows.where(F.col("appris") & (F.get("regresseurs", F.lit(0)) != 0)).count() > 0
    # Flu of the test days is that of the months, not the real one.
    assert rows.where(~F.col("appris") & (F.get("regresseurs", F.lit(3)) != F.month("ds").isin(1, 2, 3).cast("double"))).count() == 0


@pytest.mark.parametrize("days", [2, 3, 5, 17, 28, 40])
def test_breaks_of_short_histories(spark, days):
    rows = [("p", dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i % 3)) for i in range(days)]
    dense = spark.createDataFrame(rows, "nom_produit string, ds date, y double")
    expected = {r["changepoint"] for r in series.auto_changepoints(dense).collect()}
    last = ridge.forecast_rows(dense, None, 1).where("futur").first()
    breaks = last["ruptures"]
    assert len(breaks) == 25
    inside = {d for d in expected if dt.date(2024, 1, 1) < d < dt.date(2024, 1, 1) + dt.timedelta(days=days - 1)}
    assert sum(b > 0 for b in breaks) == len(inside)


def test_training_days_do_not_see_the_test_days(spark):
    """A temperature of the test days changes neither the gap filling of training days nor a blind forecast."""
    def blind(test_temperature):
        rows = [("p", dt.date(2022, 1, 1) + dt.timedelta(days=i), float(i % 7), 10.0 if i < 335 else test_temperature, 50.0, 5.0, 0, 0, 0, 0)
                for i in range(700) if i % 11]
        daily = spark.createDataFrame(rows, "nom_produit string, date date, quantite double, temperature double, taux_occupation double, nb_patients double, "
                                            "epidemie_grippe int, vacances_scolaires int, jour_ferie int, covid_impact int")
        dense = series.dense_daily_regressors(daily, train_days=365)
        found = ridge.backtest_ridge(dense, [], ridge.CONFIGS["enrichi"], blind=True)
        return [round(r["yhat"], 6) for r in found.orderBy("ds").collect()]

    assert blind(10.0) == blind(35.0)
