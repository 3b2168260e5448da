"""Result tables as they are handed out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.fixed_values import CONFIDENCE_LABEL
from larder.functions.columns import half_even, with_keys

FORECAST_CSV_SCHEMA = (
    "date date, quantite_prevue double, quantite_min double, quantite_max double, "
    "produit string, unite string, confiance string"
)


def product_units(mv: DataFrame) -> DataFrame:
    """The unit each product is counted in."""
    return with_keys(mv, ["nom_produit"]).groupBy("nom_produit").agg(F.min("unite").alias("unite"))


def forecast_export(forecast: DataFrame, units: DataFrame, rounded: bool = True) -> DataFrame:
    """Forecast under its published column names, with the product's own unit."""

    def value(name):
        return half_even(F.col(name)) if rounded else F.col(name)

    return forecast.join(units, "nom_produit", "left").select(
        F.col("ds").alias("date"),
        value("yhat").alias("quantite_prevue"),
        value("yhat_lower").alias("quantite_min"),
        value("yhat_upper").alias("quantite_max"),
        F.col("nom_produit").alias("produit"),
        "unite",
        F.lit(CONFIDENCE_LABEL).alias("confiance"),
    )
