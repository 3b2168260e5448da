"""Consumption analysis: rankings, shelf life, seasonality, suppliers, daily demand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.fixed_values import (
    CONSUMED,
    FIRST_WEEKEND_DAY,
    FLAG_REGRESSORS,
    FOOD,
    MEAN_REGRESSORS,
    MONTHS,
    OUTGOING,
    PERISHABLE_LIFE_DAYS,
    WEEKDAYS,
)
from larder.functions.columns import (
    half_even,
    is_cold_season,
    is_weekend,
    percent,
    perishability,
    shelf_life,
    total,
    with_keys,
)

# --- filters ------------------------------------------------------------------


def outgoing(mv: DataFrame) -> DataFrame:
    return mv.where(F.col("type_operation") == OUTGOING)


def consumed(mv: DataFrame) -> DataFrame:
    """Outgoing rows that were eaten or used, without the destroyed ones."""
    return mv.where(F.col("type_sortie") == CONSUMED)


def food(mv: DataFrame) -> DataFrame:
    return mv.where(F.col("type_produit") == FOOD)


def focus(mv: DataFrame, *products: str) -> DataFrame:
    """Rows of the named products; every product when none is named."""
    return mv.where(F.col("nom_produit").isin(*products)) if products else mv


# --- rankings -----------------------------------------------------------------


def top_products(
    out: DataFrame, n: int = 10, keys: Sequence[str] = ("nom_produit", "type_produit", "unite")
) -> DataFrame:
    return (
        with_keys(out, keys).groupBy(*keys)
        .agg(total("quantite").alias("volume_total"), F.count("id_lot").alias("nb_sorties"))
        .orderBy(F.desc("volume_total"), *keys)
        .limit(n)
    )


def shelf_life_by_product(foods: DataFrame, below: float | None = None) -> DataFrame:
    """Mean, least and greatest shelf life per product, with its perishability class."""
    life = (
        with_keys(foods, ["nom_produit"]).groupBy("nom_produit")
        .agg(
            F.avg(shelf_life()).alias("_vie"),
            F.min(shelf_life()).alias("duree_min"),
            F.max(shelf_life()).alias("duree_max"),
        )
    )
    rounded = life.select(
        "nom_produit",
        half_even(F.col("_vie")).alias("duree_moyenne"),
        "duree_min",
        "duree_max",
        perishability(F.col("_vie")).alias("classe"),
    )
    if below is not None:
        rounded = rounded.where(F.col("duree_moyenne") < below)
    return rounded.orderBy("duree_moyenne", "nom_produit")


def perishable_products(foods: DataFrame) -> DataFrame:
    return shelf_life_by_product(foods, PERISHABLE_LIFE_DAYS)


def most_perishable(foods: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products with the shortest mean life, unrounded."""
    life = with_keys(foods, ["nom_produit"]).groupBy("nom_produit").agg(F.avg(shelf_life()).alias("duree_moyenne"))
    return life.withColumn("classe", perishability(F.col("duree_moyenne"))).orderBy("duree_moyenne", "nom_produit").limit(n)


def supplier_performance(mv: DataFrame, n: int | None = None) -> DataFrame:
    """Deliveries, quantity over both directions and products of each supplier."""
    ranked = (
        with_keys(mv, ["nom_fournisseur"]).groupBy("nom_fournisseur")
        .agg(
            F.count_distinct("id_arrivage").alias("nb_arrivages"),
            total("quantite").alias("volume_total"),
            F.count_distinct("id_produit").alias("nb_produits_fournis"),
        )
        .orderBy(F.desc("nb_arrivages"), "nom_fournisseur")
    )
    return ranked if n is None else ranked.limit(n)


def supplier_volume_by_unit(mv: DataFrame) -> DataFrame:
    """Supplier quantities kept apart by unit, as kilograms and litres do not add up."""
    keys = ["nom_fournisseur", "unite"]
    return with_keys(mv, keys).groupBy(*keys).agg(total("quantite").alias("volume_total"))


# --- seasonality --------------------------------------------------------------


def monthly_volume(out: DataFrame, n: int | None = None) -> DataFrame:
    months = (
        out.withColumn("mois", F.trunc("date", "month")).where(F.col("mois").isNotNull())
        .groupBy("mois")
        .agg(total("quantite").alias("volume_total"), F.count("id_lot").alias("nb_sorties"))
        .orderBy("mois")
    )
    return months if n is None else months.limit(n)


def _labels(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


def _by_month(out: DataFrame) -> DataFrame:
    return (
        out.withColumn("mois", F.month("date")).where(F.col("mois").isNotNull()).groupBy("mois")
        .agg(
            F.avg("quantite").alias("moyenne"),
            total("quantite").alias("total"),
            F.stddev_samp("quantite").alias("ecart"),
        )
    )


def month_seasonality(out: DataFrame) -> DataFrame:
    """Quantity per movement by month of year, over all years."""
    labels = F.broadcast(_labels(out, MONTHS, "mois int, libelle string"))
    return (
        _by_month(out).join(labels, "mois")
        .select(
            "mois",
            "libelle",
            half_even(F.col("moyenne")).alias("moyenne_quotidienne"),
            half_even(F.col("total")).alias("total_mensuel"),
            half_even(F.col("ecart")).alias("ecart_type"),
            is_cold_season(F.col("mois")).alias("saison_froide"),
        )
        .orderBy("mois")
    )


def seasonal_extremes(out: DataFrame) -> DataFrame:
    """Peak and low month of the rounded monthly means (the earlier month on ties), and their gap in percent."""
    months = _by_month(out).select("mois", half_even(F.col("moyenne")).alias("m")).where(F.col("m").isNotNull())
    ends = months.agg(
        F.max(F.struct("m", (-F.col("mois")).alias("moins_mois"))).alias("haut"),
        F.min(F.struct("m", "mois")).alias("bas"),
    )
    high, low = F.col("haut").getField("m"), F.col("bas").getField("m")
    return ends.select(
        (-F.col("haut").getField("moins_mois")).alias("mois_max"),
        high.alias("moyenne_max"),
        F.col("bas").getField("mois").alias("mois_min"),
        low.alias("moyenne_min"),
        percent(high - low, low).alias("variation_pct"),
    )


def annual_mean_line(out: DataFrame) -> DataFrame:
    """Mean of the monthly means, each month weighing the same."""
    return _by_month(out).agg(F.avg("moyenne").alias("moyenne_annuelle"))


def weekday_pattern(out: DataFrame) -> DataFrame:
    """Mean quantity per weekday, Monday first; a weekday without rows stays null."""
    means = (
        out.groupBy(F.weekday("date").alias("jour_semaine")).agg(half_even(F.avg("quantite")).alias("moyenne"))
    )
    labels = _labels(out, WEEKDAYS, "jour_semaine int, nom_jour string, libelle string")
    return (
        labels.join(means, "jour_semaine", "left")
        .withColumn("week_end", is_weekend(F.col("jour_semaine")))
        .select("jour_semaine", "nom_jour", "libelle", "moyenne", "week_end")
        .orderBy("jour_semaine")
    )


def weekend_gap(out: DataFrame) -> DataFrame:
    """Weekday against weekend mean, each weekday weighing the same."""
    week = F.avg(F.when(F.col("jour_semaine") < FIRST_WEEKEND_DAY, F.col("moyenne")))
    weekend = F.avg(F.when(F.col("jour_semaine") >= FIRST_WEEKEND_DAY, F.col("moyenne")))
    return weekday_pattern(out).agg(
        week.alias("moyenne_semaine"),
        weekend.alias("moyenne_week_end"),
        percent(weekend - week, week).alias("ecart_pct"),
    )


# --- one product at a time, for all products ----------------------------------


def product_card(out: DataFrame) -> DataFrame:
    return (
        with_keys(out, ["nom_produit"]).groupBy("nom_produit")
        .agg(
            F.count("*").alias("nb_sorties"),
            F.min("date").alias("debut"),
            F.max("date").alias("fin"),
            total("quantite").alias("volume_total"),
            F.avg("quantite").alias("moyenne_sortie"),
            F.avg(shelf_life()).alias("duree_vie_moyenne"),
        )
    )


def daily_demand(out: DataFrame, regressors: bool = False) -> DataFrame:
    """Quantity per product and day, optionally with the day's regressors."""
    extra: list[Column] = []
    if regressors:
        extra = [F.avg(c).alias(c) for c in MEAN_REGRESSORS] + [F.max(c).alias(c) for c in FLAG_REGRESSORS]
    keys = ["nom_produit", "date"]
    return with_keys(out, keys).groupBy(*keys).agg(total("quantite").alias("quantite"), *extra)


def daily_stats(daily: DataFrame) -> DataFrame:
    """Spread of daily demand over the days that have movements."""
    return daily.groupBy("nom_produit").agg(
        F.avg("quantite").alias("moyenne"),
        F.median("quantite").alias("mediane"),
        F.min("quantite").alias("minimum"),
        F.max("quantite").alias("maximum"),
        F.stddev_samp("quantite").alias("ecart_type"),
    )


def moving_avg(daily: DataFrame, rows: Sequence[int] = (7, 30)) -> DataFrame:
    """Trailing means over the last rows of each product, shorter at the start."""
    by_day = Window.partitionBy("nom_produit").orderBy("date")
    return daily.select(
        "nom_produit", "date", "quantite",
        *[F.avg("quantite").over(by_day.rowsBetween(1 - n, 0)).alias(f"ma{n}") for n in rows],
    )
