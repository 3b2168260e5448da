"""Per-product summary, flat and as a nested document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.fixed_values import (
    CONFIDENCE_LABEL,
    DATASET_VERSION,
    FORECAST_DAYS,
    HOLIDAY_FLAGS,
    MODEL_REGRESSORS,
    SEASON_ADVICE,
)
from larder.functions.columns import half_even
from larder.functions.solver import Config
from larder.operators.evaluate import verdict
from larder.operators.replenish import replenishment


def history_stats(daily: DataFrame) -> DataFrame:
    """Span of each product's history and spread over its days with demand."""
    first, last = F.min("date"), F.max("date")
    return daily.groupBy("nom_produit").agg(
        first.alias("debut"),
        last.alias("fin"),
        (F.datediff(last, first) + 1).alias("nb_jours"),
        F.stddev_samp("quantite").alias("ecart_type"),
    )


def product_summary(
    daily: DataFrame, forecast: DataFrame, stock: DataFrame, scores: DataFrame | None = None
) -> DataFrame:
    """Everything reported about a product, one row each, unrounded.

    ``consommation_moyenne_jour`` is the forecast mean, as in the reports this
    replaces. Without ``scores`` the quality columns stay null.
    """
    summary = history_stats(daily).join(replenishment(forecast, stock), "nom_produit")
    if scores is not None:
        summary = summary.join(scores.select("nom_produit", "mae", "mape", "rmse"), "nom_produit", "left")
    else:
        nothing = F.lit(None).cast("double")
        summary = summary.withColumns({"mae": nothing, "mape": nothing, "rmse": nothing})
    return summary.withColumns({
        "consommation_moyenne_jour": F.col("moyenne_jour"),
        "verdict": verdict(F.col("mape")),
    })


def nested_summary(
    summary: DataFrame, method: str, analysed_at: Column | None = None, changepoints: Sequence[str] = (),
    dataset: DataFrame | None = None, events: DataFrame | None = None, model: Config | None = None,
) -> DataFrame:
    """The summary as one document per product, numbers rounded to 2 digits.

    ``model`` is the configuration of the regression that made the forecast; other
    methods have none, and their document lists no events, regressors or seasons.
    ``dataset`` is the one-row profile ``nb_lignes, debut, fin`` of the table the
    summary comes from, ``events`` the event days of each product; what is not
    given stays null.
    """
    total, since, until = (
        (dataset.select(c).scalar() for c in ("nb_lignes", "debut", "fin")) if dataset is not None
        else (F.lit(None).cast(t) for t in ("long", "date", "date"))
    )
    if events is not None:
        summary = summary.join(
            events.groupBy("nom_produit").agg(F.count("*").alias("nb_holidays")), "nom_produit", "left"
        ).fillna(0, ["nb_holidays"])
    else:
        summary = summary.withColumn("nb_holidays", F.lit(None).cast("long"))

    def two(name):
        return half_even(F.col(name)).alias(name)

    def text(day):
        return F.date_format(day, "yyyy-MM-dd")

    outside = model is not None and model.outside
    first_day, last_day = F.date_add("fin", 1), F.date_add("fin", FORECAST_DAYS)
    configuration = F.struct(
        F.array(*[F.lit(label) for label, _ in HOLIDAY_FLAGS if outside]).cast("array<string>").alias("holidays"),
        "nb_holidays",
        F.array(*[F.lit(d) for d in changepoints]).cast("array<string>").alias("changepoints"),
        F.lit(len(changepoints)).alias("nb_changepoints"),
        F.array(*[F.lit(name) for name, _, _ in MODEL_REGRESSORS if outside]).cast("array<string>").alias("regresseurs"),
        F.struct(
            F.lit(model.yearly if model else None).cast("int").alias("yearly"),
            F.lit(model.weekly if model else None).cast("int").alias("weekly"),
            F.lit(("multiplicative" if model.multiplicative else "additive") if model else None).cast("string").alias("mode"),
        ).alias("seasonality"),
    )
    # --- Fixed values: the keys of the document ---
    return summary.select(
        F.col("nom_produit").alias("produit"),
        F.date_format(F.current_timestamp() if analysed_at is None else analysed_at, "yyyy-MM-dd HH:mm:ss").alias("date_analyse"),
        F.struct(
            F.lit(DATASET_VERSION).alias("version"), total.alias("nb_lignes_total"), F.concat_ws(" → ", text(since), text(until)).alias("periode_donnees"),
        ).alias("dataset"),
        F.struct(text("debut").alias("debut"), text("fin").alias("fin"), "nb_jours").alias("periode_historique"),
        F.struct(two("consommation_moyenne_jour"), two("duree_vie_moyenne"), two("ecart_type")).alias("statistiques"),
        F.struct(
            half_even(F.col("mae")).alias("MAE"), half_even(F.col("mape")).alias("MAPE"),
            half_even(F.col("rmse")).alias("RMSE"), F.lit(method).alias("methode"), "verdict",
        ).alias("performance_modele"),
        configuration.alias("configuration_modele"),
        F.struct(
            F.lit(f"{FORECAST_DAYS} jours").alias("horizon"),
            F.concat_ws(" → ", text(first_day), text(last_day)).alias("periode"),
            two("total_prevu"), two("moyenne_jour"), two("minimum"), two("maximum"),
            F.lit(CONFIDENCE_LABEL).alias("intervalle_confiance"),
        ).alias("predictions"),
        F.struct(
            two("stock_actuel"),
            F.col("horizon").alias("horizon_commande_jours"),
            two("commande_suggeree"), two("commande_min"), two("commande_max"),
            # Without demand the stock lasts 0 days by convention; an unknown stock stays unknown.
            F.when(F.col("moyenne_jour") <= 0, 0.0).otherwise(F.bround("duree_stock_jours", 1)).alias("duree_stock_actuel_jours"),
            half_even(F.col("risque_gaspillage")).alias("risque_gaspillage_kg"),
            two("commande_hebdomadaire"), two("stock_securite"),
            F.lit(SEASON_ADVICE).alias("attention"),
        ).alias("recommandations"),
    )
