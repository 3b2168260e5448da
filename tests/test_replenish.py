"""Order arithmetic against a recorded report and hand-made cases."""

import pytest

from conftest import day
from larder.operators import forecast, report, replenish
from larder.operators.demand import daily_demand
from larder.operators.series import dense_daily

# A recorded four-week forecast and the report that came with it.
FORECAST = [
    11.64, 12.03, 12.08, 9.25, 9.16, 12.12, 12.06, 11.79, 12.19, 12.25, 9.43, 9.33, 12.29, 12.22,
    11.94, 12.33, 12.38, 9.54, 9.42, 12.37, 12.28, 11.99, 12.37, 12.41, 9.56, 9.45, 12.39, 12.32,
]
STOCK, LIFE = 9076.23, 1.9995


def frames(spark, values, stock, life, lower=None, upper=None):
    days = [("p", day(f"2025-01-{i:02}"), v, lower, upper) for i, v in enumerate(values, 1)]
    return (
        spark.createDataFrame(days, "nom_produit string, ds date, yhat double, yhat_lower double, yhat_upper double"),
        spark.createDataFrame([("p", stock, life)], "nom_produit string, stock_actuel double, duree_vie_moyenne double"),
    )


def test_recorded_report(spark):
    row = replenish.replenishment(*frames(spark, FORECAST, STOCK, LIFE)).first()
    assert round(row["total_prevu"], 2) == 318.59
    assert (round(row["moyenne_jour"], 2), row["minimum"], row["maximum"]) == (11.38, 9.16, 12.41)
    assert row["horizon"] == 1 and row["besoin"] == 11.64
    assert (row["commande_suggeree"], row["commande_min"], row["commande_max"]) == (0.0, 0.0, 0.0)
    assert round(row["duree_stock_jours"], 1) == 797.7
    assert round(row["risque_gaspillage"], 2) == pytest.approx(9053.48, abs=0.01)
    assert row["statut_stock"] == "suffisant" and row["actions"].count(";") == 3


def test_unknown_stock_stays_unknown(spark):
    forecast_days, stock = frames(spark, [10.0] * 28, None, 5.0)
    row = replenish.replenishment(forecast_days, stock).first()
    assert row["besoin"] == 50.0 and row["statut_stock"] == "inconnu"
    for name in ("commande_suggeree", "commande_min", "commande_max", "duree_stock_jours", "risque_gaspillage", "pct_risque", "actions"):
        assert row[name] is None
    # A known stock without demand lasts 0 days in the document, an unknown one has no figure.
    daily = spark.createDataFrame([("p", day("2025-01-01"), 1.0)], "nom_produit string, date date, quantite double")
    for given, expected in ((None, None), (4.0, 0.4)):
        forecast_days, stock = frames(spark, [10.0] * 28, given, 5.0)
        document = report.nested_summary(report.product_summary(daily, forecast_days, stock), "natif").first()
        assert document["recommandations"]["duree_stock_actuel_jours"] == expected
    forecast_days, stock = frames(spark, [0.0] * 28, 4.0, 5.0)
    assert report.nested_summary(report.product_summary(daily, forecast_days, stock), "natif").first()["recommandations"]["duree_stock_actuel_jours"] == 0.0


def test_short_positive_stock(spark):
    row = replenish.replenishment(*frames(spark, [2.0] * 28, 5.0, 6.4)).first()
    assert (row["horizon"], row["besoin"], row["commande_suggeree"]) == (6, 12.0, 7.0)
    assert (row["duree_stock_jours"], row["risque_gaspillage"], row["actions"]) == (2.5, 0.0, None)
    # Without an interval the need gets a 15 % band.
    assert row["commande_min"] == pytest.approx(12 * 0.85 - 5) and row["commande_max"] == pytest.approx(12 * 1.15 - 5)


@pytest.mark.parametrize("stock, status", [(1.0, "critique"), (3.0, "faible"), (4.0, "suffisant")])
def test_cover_status(spark, stock, status):
    assert replenish.stock_cover(*frames(spark, [2.0] * 28, stock, 30.0)).first()["statut_stock"] == status


def test_no_demand_gives_no_cover(spark):
    row = replenish.replenishment(*frames(spark, [0.0] * 28, 4.0, 5.0)).first()
    assert row["duree_stock_jours"] is None and row["statut_stock"] is None
    assert row["risque_gaspillage"] == 4.0 and row["pct_risque"] == 100.0


def test_expired_life_orders_nothing(spark):
    row = replenish.replenishment(*frames(spark, [2.0] * 28, 1.0, -3.0)).first()
    assert (row["horizon"], row["besoin"], row["commande_suggeree"]) == (0, 0.0, 0.0)


def test_weekly_order_and_safety_stock(spark):
    fc, _ = frames(spark, [2.0, 4.0], 0.0, 5.0, 1.0, 5.0)
    assert tuple(replenish.weekly_order_safety_stock(fc).first()) == ("p", 21.0, 6.0)


def test_single_movement_forecasts_its_value(make):
    daily = daily_demand(make({"quantite": 4.0}))
    for fc in (forecast.forecast_native(daily), forecast.forecast_moving_average(dense_daily(daily))):
        found = fc.orderBy("ds").collect()
        assert len(found) == 28 and found[0]["ds"] == day("2024-01-02")
        assert all(r["yhat"] == 4.0 for r in found)


def test_nested_summary_shape(make):
    daily = daily_demand(make({"quantite": 4.0}, {"date": day("2024-01-03"), "quantite": 2.0}))
    stock = replenish.stock_and_life(make({}))
    flat = report.product_summary(daily, forecast.forecast_moving_average(dense_daily(daily)), stock)
    doc = report.nested_summary(flat, "moyenne mobile").first().asDict(recursive=True)
    assert doc["periode_historique"] == {"debut": "2024-01-01", "fin": "2024-01-03", "nb_jours": 3}
    assert doc["statistiques"]["consommation_moyenne_jour"] == 2.0
    assert doc["performance_modele"]["MAE"] is None
    assert doc["recommandations"]["horizon_commande_jours"] == 4
