"""Forecast quality and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.fixed_values import MAPE_EXCELLENT, MAPE_GOOD, MAPE_GUARD


def backtest_join(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Actual and predicted values of the same product and day."""
    return actual.select("nom_produit", "ds", "y").join(forecast.drop("y"), ["nom_produit", "ds"])


def metrics(pairs: DataFrame, by: Sequence[str] = ("nom_produit",), guard: float = MAPE_GUARD) -> DataFrame:
    """MAE, MAPE and RMSE per group, with WAPE, which days without demand do not blow up."""
    error = F.col("y") - F.col("yhat")
    return pairs.groupBy(*by).agg(
        F.count("*").alias("nb_jours"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(F.abs(F.try_divide(error, F.col("y") + guard))) * 100).alias("mape"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.try_divide(F.sum(F.abs(error)), F.sum(F.abs("y"))) * 100).alias("wape"),
    )


def verdict(mape: Column, excellent: float = MAPE_EXCELLENT, good: float = MAPE_GOOD) -> Column:
    return F.when(mape < excellent, "excellente").when(mape < good, "bonne").when(mape.isNotNull(), "moyenne")


def ranked(scores: DataFrame, model: str = "modele", by: str = "mae", digits: int = 6) -> DataFrame:
    """Models of each product from best to worst; equal scores keep the name order."""
    best_first = Window.partitionBy("nom_produit").orderBy(F.round(by, digits), model)
    return scores.withColumn("rang", F.row_number().over(best_first))


def over_origins(scores: DataFrame, by: str = "mae", digits: int = 6) -> DataFrame:
    """Scores at several cut dates (``date_coupure``) with each model's rank at its cut and its mean rank and error over all cuts.

    Models rank within a product and cut; a model without score at a cut ranks last there.
    """
    at_cut = Window.partitionBy("nom_produit", "date_coupure").orderBy(F.round(by, digits).asc_nulls_last(), "modele")
    over_cuts = Window.partitionBy("nom_produit", "modele")
    return scores.withColumn("rang", F.row_number().over(at_cut)).withColumns({
        "nb_coupures": F.count("*").over(over_cuts),
        "rang_moyen": F.avg("rang").over(over_cuts),
        f"{by}_moyenne": F.avg(by).over(over_cuts),
        f"{by}_pire": F.max(by).over(over_cuts),
    })


def forecast_summary(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("nom_produit").agg(
        F.sum("yhat").alias("total_prevu"),
        F.avg("yhat").alias("moyenne_jour"),
        F.min("yhat").alias("minimum"),
        F.max("yhat").alias("maximum"),
        F.stddev_samp("yhat").alias("ecart_type"),
        F.sum("yhat_lower").alias("scenario_bas"),
        F.sum("yhat_upper").alias("scenario_haut"),
    )
