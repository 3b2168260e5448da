"""From forecasts to orders, days of cover and waste risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.fixed_values import (
    COVER_CRITICAL_DAYS,
    COVER_LOW_DAYS,
    FALLBACK_BAND,
    PERISHABLE_LIFE_DAYS,
    SAFETY_FACTOR,
    UNKNOWN_STOCK,
    WASTE_ACTIONS,
)
from larder.functions.columns import percent, shelf_life, with_keys

# A table has no row order, so the last movement is the greatest in this order.
MOVEMENT_ORDER = ["date", "type_operation", "id_lot", "id_produit", "quantite", "stock_theorique"]


def stock_and_life(out: DataFrame) -> DataFrame:
    """Stock after the last outgoing row and mean shelf life of each product.

    The last row comes from a maximum, which combines map-side: no task ever
    holds all rows of a product.
    """
    return (
        with_keys(out, ["nom_produit"]).groupBy("nom_produit")
        .agg(
            F.max(F.struct(*MOVEMENT_ORDER)).getField("stock_theorique").alias("stock_actuel"),
            F.avg(shelf_life()).alias("duree_vie_moyenne"),
        )
    )


def order_horizon(life: Column, max_life: int = PERISHABLE_LIFE_DAYS) -> Column:
    """Whole days to order for: the shelf life of perishables, a week for the rest."""
    return F.when(life < max_life, F.greatest(life.cast("int"), F.lit(0))).otherwise(max_life)


def _with_horizon(forecast: DataFrame, stock: DataFrame, max_life: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("nom_produit").orderBy("ds"))
    return (
        forecast.withColumn("_rang", rank).join(stock, "nom_produit", "left")
        .withColumn("horizon", order_horizon(F.col("duree_vie_moyenne"), max_life))
    )


def replenishment(forecast: DataFrame, stock: DataFrame, max_life: int = PERISHABLE_LIFE_DAYS) -> DataFrame:
    """Everything an order decision needs, one row per product.

    Where the stock is unknown, so are the order and the waste risk: ``statut_stock`` is then ``inconnu``.
    """
    near = F.col("_rang") <= F.col("horizon")
    lower = F.coalesce(F.col("yhat_lower"), F.col("yhat") * (1 - FALLBACK_BAND))
    upper = F.coalesce(F.col("yhat_upper"), F.col("yhat") * (1 + FALLBACK_BAND))

    def need(value):
        return F.coalesce(F.sum(F.when(near, value)), F.lit(0.0))

    per_product = _with_horizon(forecast, stock, max_life).groupBy(
        "nom_produit", "stock_actuel", "duree_vie_moyenne", "horizon"
    ).agg(
        need(F.col("yhat")).alias("besoin"),
        need(lower).alias("besoin_min"),
        need(upper).alias("besoin_max"),
        F.sum("yhat").alias("total_prevu"),
        F.avg("yhat").alias("moyenne_jour"),
        F.min("yhat").alias("minimum"),
        F.max("yhat").alias("maximum"),
        F.max(upper).alias("_haut"),
    )
    on_hand, daily = F.col("stock_actuel"), F.col("moyenne_jour")

    def at_least_zero(amount):
        """An unknown stock or life leaves the amount unknown: ``greatest`` alone would make it 0."""
        return F.when(amount.isNotNull(), F.greatest(F.lit(0.0), amount))

    def order(needed):
        return at_least_zero(F.col(needed) - on_hand)

    cover = F.when(daily > 0, F.try_divide(on_hand, daily))
    usable = F.col("duree_vie_moyenne") * daily
    risk = at_least_zero(on_hand - usable)
    return (
        per_product.withColumns({
            "commande_suggeree": order("besoin"),
            "commande_min": order("besoin_min"),
            "commande_max": order("besoin_max"),
            "duree_stock_jours": cover,
            "capacite_consommation": usable,
            "risque_gaspillage": risk,
            "commande_hebdomadaire": daily * 7,
            "stock_securite": F.col("_haut") * SAFETY_FACTOR,
        })
        .withColumns({
            "statut_stock": F.when(on_hand.isNull(), UNKNOWN_STOCK)
            .when(F.col("duree_stock_jours") < COVER_CRITICAL_DAYS, "critique")
            .when(F.col("duree_stock_jours") < COVER_LOW_DAYS, "faible")
            .when(F.col("duree_stock_jours").isNotNull(), "suffisant"),
            "pct_risque": F.when(F.col("risque_gaspillage") > 0, percent(F.col("risque_gaspillage"), on_hand)),
            "actions": F.when(F.col("risque_gaspillage") > 0, F.lit(";".join(WASTE_ACTIONS))),
        })
        .drop("_haut")
    )


def order_recommendation(forecast: DataFrame, stock: DataFrame, max_life: int = PERISHABLE_LIFE_DAYS) -> DataFrame:
    return replenishment(forecast, stock, max_life).select(
        "nom_produit", "stock_actuel", "duree_vie_moyenne", "horizon",
        "besoin", "besoin_min", "besoin_max", "commande_suggeree", "commande_min", "commande_max",
    )


def stock_cover(forecast: DataFrame, stock: DataFrame) -> DataFrame:
    return replenishment(forecast, stock).select(
        "nom_produit", "stock_actuel", "moyenne_jour", "duree_stock_jours", "statut_stock"
    )


def waste_risk(forecast: DataFrame, stock: DataFrame) -> DataFrame:
    return replenishment(forecast, stock).select(
        "nom_produit", "stock_actuel", "capacite_consommation", "risque_gaspillage", "pct_risque", "actions"
    )


def weekly_order_safety_stock(forecast: DataFrame) -> DataFrame:
    """A week's mean demand, and the highest upper bound with a safety factor."""
    return forecast.groupBy("nom_produit").agg(
        (F.avg("yhat") * 7).alias("commande_hebdomadaire"),
        (F.max("yhat_upper") * SAFETY_FACTOR).alias("stock_securite"),
    )
