"""Properties that hold for any series. Random products share one job, keyed by product."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.operators import forecast, replenish, series

SCHEMA = "nom_produit string, date date, quantite double"
START = dt.date(2023, 1, 1)

products = st.dictionaries(
    st.sampled_from("abcdefgh"),
    st.dictionaries(st.integers(0, 500), st.integers(0, 60), min_size=1, max_size=25),
    min_size=1, max_size=6,
)
few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, data):
    rows = [(p, START + dt.timedelta(days=d), float(q)) for p, days in data.items() for d, q in days.items()]
    return spark.createDataFrame(rows, SCHEMA)


@few
@given(products)
def test_dense_series_has_every_day_once_and_keeps_the_total(spark, data):
    dense = series.dense_daily(frame(spark, data))
    for r in dense.groupBy("nom_produit").agg(F.count("*").alias("n"), F.count_distinct("ds").alias("d"), F.sum("y").alias("s")).collect():
        days = data[r["nom_produit"]]
        assert r["n"] == r["d"] == max(days) - min(days) + 1
        assert r["s"] == sum(days.values())


@few
@given(products, st.sampled_from([{"share": 0.2}, {"days": 30}]))
def test_split_is_a_partition(spark, data, how):
    split = series.with_split(series.dense_daily(frame(spark, data)), **how)
    for r in series.split_summary(split).collect():
        days = data[r["nom_produit"]]
        n = max(days) - min(days) + 1
        assert r["nb_apprentissage"] + r["nb_test"] == n
        assert r["nb_test"] == (int(n * 0.2) if "share" in how else min(30, n))


@few
@given(products)
def test_forecast_bounds_and_orders_are_ordered(spark, data):
    daily = frame(spark, data)
    fc = forecast.forecast_native(daily)
    stock = daily.groupBy("nom_produit").agg(F.lit(20.0).alias("stock_actuel"), F.avg("quantite").alias("duree_vie_moyenne"))
    found = replenish.replenishment(fc, stock).collect()
    assert len(found) == len(data)
    for r in found:
        assert r["besoin_min"] <= r["besoin"] + 1e-9 <= r["besoin_max"] + 2e-9
        assert 0 <= r["commande_min"] <= r["commande_suggeree"] + 1e-9 <= r["commande_max"] + 2e-9
    assert fc.where("yhat_lower > yhat or yhat > yhat_upper").count() == 0


def test_split_needs_exactly_one_length(spark):
    with pytest.raises(ValueError):
        series.with_split(series.dense_daily(frame(spark, {"a": {0: 1}})))
