"""Null, tie, rounding and empty-group rules that results depend on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import day
from larder.functions import columns as C
from larder.operators import demand, quality, replenish, series


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_null_product_forms_no_group(make):
    mv = make({"nom_produit": None}, {"nom_produit": "riz"})
    assert [r[0] for r in rows(demand.daily_demand(mv))] == ["riz"]
    assert [r[0] for r in rows(demand.top_products(mv, keys=["nom_produit"]))] == ["riz"]


def test_sum_of_only_nulls_is_zero_and_count_skips_nulls(make):
    mv = make({"quantite": None, "id_lot": None})
    assert rows(demand.top_products(mv, keys=["nom_produit"])) == [("riz", 0.0, 0)]


def test_deviation_of_one_row_is_null(make):
    assert rows(demand.daily_stats(demand.daily_demand(make({"quantite": 3.0})))) == [("riz", 3.0, 3.0, 3.0, 3.0, None)]


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,)], "x double")
    assert rows(df.select(C.half_even(F.col("x")))) == [(0.12,), (0.38,)]


def test_top_products_breaks_ties_by_name(make):
    mv = make(*[{"nom_produit": p, "quantite": 2.0} for p in ("c", "a", "b")])
    assert [r[0] for r in rows(demand.top_products(mv, 2, ["nom_produit"]))] == ["a", "b"]


def test_monthly_peak_tie_takes_earlier_month(make):
    mv = make(*[{"date": day(f"2024-{m:02}-01"), "quantite": q} for m, q in ((1, 1.0), (3, 5.0), (7, 5.0), (9, 1.0))])
    assert rows(demand.seasonal_extremes(mv)) == [(3, 5.0, 1, 1.0, 400.0)]


def test_weekday_without_rows_stays_null(make):
    pattern = rows(demand.weekday_pattern(make({"date": day("2024-01-01"), "quantite": 4.0})))
    assert [r[1] for r in pattern][:2] == ["Monday", "Tuesday"] and len(pattern) == 7
    assert pattern[0][3] == 4.0 and pattern[1][3] is None


def test_calendar_columns(spark):
    df = C.add_calendar(spark.createDataFrame([(day("2024-12-30"),)], "date date"))
    assert rows(df) == [(day("2024-12-30"), 2024, 12, 30, 0, "Monday", 1)]


def test_shares_and_waste(make):
    mv = make({"quantite": 3.0}, {"type_sortie": "DESTRUCTION", "quantite": 1.0},
              {"type_operation": "ENTREE", "type_sortie": None, "quantite": 9.0})
    assert rows(quality.waste_rate(mv)) == [(1.0, 3.0, 25.0)]
    shares = {(r[0], r[1]): r[3:] for r in rows(quality.operation_shares(mv))}
    assert shares["SORTIE", "DESTRUCTION"] == (pytest.approx(100 / 3), 50.0)
    assert sum(s[0] for s in shares.values()) == pytest.approx(100)


def test_waste_rate_without_exits_is_null(make):
    mv = make({"type_operation": "ENTREE", "type_sortie": None})
    assert rows(quality.waste_rate(mv)) == [(0.0, 0.0, None)]


def test_gap_filled_series_and_moving_average(make):
    daily = demand.daily_demand(make({"quantite": 3.0}, {"date": day("2024-01-04"), "quantite": 5.0}))
    dense = series.dense_daily(daily)
    assert [r[2] for r in sorted(rows(dense))] == [3.0, 0.0, 0.0, 5.0]
    as_daily = dense.select("nom_produit", F.col("ds").alias("date"), F.col("y").alias("quantite"))
    assert [r[3] for r in sorted(rows(demand.moving_avg(as_daily, [7])))] == [3.0, 1.5, 1.0, 2.0]


def test_regressor_fill(make):
    daily = demand.daily_demand(make(
        {"temperature": 10.0, "jour_ferie": 1}, {"date": day("2024-01-02"), "temperature": None},
        {"date": day("2024-01-04"), "temperature": 20.0}), regressors=True)
    dense = sorted(rows(series.dense_daily_regressors(daily).select("ds", "y", "temperature", "jour_ferie")))
    assert [r[1:] for r in dense] == [(1.0, 10.0, 1), (1.0, 15.0, 0), (0.0, 15.0, 0), (1.0, 20.0, 0)]


def test_regressor_fill_from_training_days_only(make):
    daily = demand.daily_demand(make(
        {"temperature": 10.0}, {"date": day("2024-01-04"), "temperature": 20.0}), regressors=True)
    dense = sorted(rows(series.dense_daily_regressors(daily, train_days=1).select("ds", "temperature")))
    assert [r[1] for r in dense] == [10.0, 10.0, 10.0, 20.0]


def _dense(make, start, end):
    return series.dense_daily(demand.daily_demand(make({"date": day(start)}, {"date": day(end)})))


def test_last_year_split_on_leap_year(make):
    split = series.split_365(_dense(make, "2020-01-01", "2024-12-31")).first()
    assert (split["date_coupure"], split["nb_test"]) == (day("2024-01-01"), 365)


def test_80_20_split(make):
    split = series.split_80_20(_dense(make, "2022-01-01", "2024-12-31")).first()
    assert (split["date_coupure"], split["nb_test"]) == (day("2024-05-26"), 219)
    assert split["nb_apprentissage"] + split["nb_test"] == 1096


def test_future_days_keep_flu_season(make):
    daily = demand.daily_demand(make({"date": day("2024-03-20")}, {"date": day("2024-03-30")}), regressors=True)
    future = series.future_frame(series.dense_daily_regressors(daily), 3).where("futur")
    assert sorted(rows(future.select("ds", "epidemie_grippe", "y"))) == [
        (day("2024-03-31"), 1, None), (day("2024-04-01"), 0, None), (day("2024-04-02"), 0, None)]


def test_one_day_carries_several_events(make):
    daily = demand.daily_demand(make({"jour_ferie": 1, "covid_impact": 1}), regressors=True)
    events = series.holidays(series.dense_daily_regressors(daily))
    assert sorted(r["holiday"] for r in events.collect()) == ["covid_19", "jour_ferie"]


def test_changepoints_outside_history_are_dropped(make):
    dense = _dense(make, "2024-01-01", "2024-06-30")
    dates = ["2023-12-31", "2024-01-01", "2024-03-01", "2024-07-01"]
    assert [r["changepoint"] for r in series.changepoints(dense, dates).collect()] == [day("2024-03-01")]


def test_auto_changepoints_of_short_history(make):
    dense = _dense(make, "2024-01-01", "2024-01-10")
    found = [r["changepoint"] for r in series.auto_changepoints(dense).orderBy("rang").collect()]
    assert found == [day("2024-01-01") + dt.timedelta(days=k) for k in range(1, 8)]


def test_missing_values_lists_only_incomplete_columns(make):
    found = rows(quality.missing_values(make({"temperature_stockage": None}, {}, {})))
    assert found == [("temperature_stockage", 1, 33.33)]


def test_event_days_are_counted_once(make):
    mv = make({"jour_ferie": 1}, {"jour_ferie": 1}, {"date": day("2024-01-03")})
    stats = {r["indicateur"]: r for r in quality.event_flag_stats(mv).collect()}
    assert (stats["jour_ferie"]["nb_lignes"], stats["jour_ferie"]["nb_jours"]) == (2, 1)


def test_supplier_ties_by_name_and_units_apart(make):
    mv = make({"nom_fournisseur": "B"}, {"nom_fournisseur": "A", "unite": "L"}, {"nom_fournisseur": None})
    assert [r[0] for r in rows(demand.supplier_performance(mv, 3))] == ["A", "B"]
    assert sorted(rows(demand.supplier_volume_by_unit(mv))) == [("A", "L", 1.0), ("B", "kg", 1.0)]


def test_last_stock_follows_the_full_order(make):
    mv = make({"date": day("2024-01-02"), "id_lot": 7, "stock_theorique": 3.0},
              {"date": day("2024-01-02"), "id_lot": 9, "stock_theorique": 1.0},
              {"date": day("2024-01-01"), "id_lot": 99, "stock_theorique": 8.0})
    assert replenish.stock_and_life(mv).first()["stock_actuel"] == 1.0


@pytest.mark.parametrize("life, horizon", [(1.9995, 1), (6.4, 6), (7.0, 7), (180.0, 7), (0.4, 0), (-2.5, 0), (None, 7)])
def test_order_horizon_truncates(spark, life, horizon):
    df = spark.createDataFrame([(life,)], "life double")
    assert df.select(replenish.order_horizon(F.col("life"))).first()[0] == horizon


def test_slug(spark):
    df = spark.createDataFrame([("Pain de mie",)], "p string")
    assert rows(df.select(C.slug("p"), C.slug("p", lower=False))) == [("pain_de_mie", "Pain_de_mie")]


def test_future_events_are_taken_from_the_given_calendar(spark, make):
    daily = demand.daily_demand(make({}, {"date": day("2024-01-02")}), regressors=True)
    events = spark.createDataFrame([(day("2024-01-03"), "jour_ferie"), (day("2024-01-04"), "covid_19")], "ds date, holiday string")
    future = series.future_frame(series.dense_daily_regressors(daily), 3, events=events).where("futur")
    found = sorted(rows(future.select("ds", "jour_ferie", "vacances_scolaires", "covid_impact", "epidemie_grippe")))
    assert [r[1:] for r in found] == [(1, 0, 0, 1), (0, 0, 1, 1), (0, 0, 0, 1)]
