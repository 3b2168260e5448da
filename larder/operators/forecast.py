"""Forecasts made of aggregates only: trend with weekday and month effects, and a moving average."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.fixed_values import BREAK_YEAR_DAYS, FALLBACK_BAND, FORECAST_DAYS, RECENT_DAYS, Z_85
from larder.functions.columns import drift_variance, total
from larder.operators.series import EPOCH, dense_daily, last_days, per_product

FORECAST_COLUMNS = ["nom_produit", "ds", "yhat", "yhat_lower", "yhat_upper"]


def native_model(days: DataFrame, train: Column | None = None, carried: Sequence[str] = (), z: float = Z_85) -> DataFrame:
    """Additive model of each product, fitted on its days ``(nom_produit, ds, y)`` or those meeting ``train``: one row per product.

    Linear trend by least squares, then the mean residual of each weekday, then of each month. All of it follows in closed form
    from the sums n, t, t*t, y, t*y and y*y of the product's days by weekday and month: one hash aggregation to 84 cells a
    product at most, which needs no sort and keeps the clustering by product that ``days`` has; all else works on the cells.

    ``debut`` and ``fin`` are the first and last day, ``effet_semaine`` (Monday first) and ``effet_mois`` are lists, with 0 where there was no such day; ``demi`` is half the
    width of the interval, ``z`` times the deviation of the residuals. The days that are not for training come along in
    ``jours`` with the columns ``carried``, so that no join has to bring them back: the calendar bounds their number. All but
    these is null for products without training days.
    """
    train = F.lit(True) if train is None else train
    t = F.datediff("ds", F.lit(EPOCH).cast("date")).cast("double")
    cells = days.groupBy("nom_produit", F.weekday("ds").alias("j"), F.month("ds").alias("m")).agg(
        F.count_if(train).cast("double").alias("n"),
        *[total(F.when(train, value)).alias(name) for name, value in {"t": t, "tt": t * t, "y": F.col("y"), "ty": t * F.col("y"), "yy": F.col("y") * F.col("y")}.items()],
        F.min(F.when(train, F.col("ds"))).alias("debut"), F.max(F.when(train, F.col("ds"))).alias("fin"),
        *([F.collect_list(F.when(~train, F.struct("ds", *carried))).alias("jours")] if carried else []))
    product = Window.partitionBy("nom_produit")
    # Days count from the product's first one: sums over dates far from 0 would cancel.
    moved = cells.withColumn("debut", F.min("debut").over(product)).withColumn("d", F.datediff("debut", F.lit(EPOCH).cast("date")).cast("double")).select(
        "nom_produit", "j", "m", "n", "y", "yy", "debut", "fin", *(["jours"] if carried else []), (F.col("t") - F.col("n") * F.col("d")).alias("t"),
        (F.col("tt") - 2 * F.col("d") * F.col("t") + F.col("n") * F.col("d") * F.col("d")).alias("tt"), (F.col("ty") - F.col("d") * F.col("y")).alias("ty"))
    n, st, stt, sy, sty = (F.sum(c).over(product) for c in ("n", "t", "tt", "y", "ty"))
    spread = n * stt - st * st
    trend = moved.withColumn("b", F.when(n > 1, F.coalesce(F.try_divide(n * sty - st * sy, spread), F.lit(0.0))).otherwise(0.0))
    trend = trend.withColumn("a", F.try_divide(F.sum("y").over(product) - F.col("b") * F.sum("t").over(product), F.sum("n").over(product)))
    left = trend.withColumn("r", F.col("y") - F.col("a") * F.col("n") - F.col("b") * F.col("t"))
    weekday = Window.partitionBy("nom_produit", "j")
    week = left.withColumn("w", F.coalesce(F.try_divide(F.sum("r").over(weekday), F.sum("n").over(weekday)), F.lit(0.0)))
    month = Window.partitionBy("nom_produit", "m")
    full = week.withColumn("e", F.coalesce(F.try_divide(F.sum(F.col("r") - F.col("w") * F.col("n")).over(month), F.sum("n").over(month)), F.lit(0.0)))
    # Residuals of a cell are y - c - b t with one constant c.
    c, b = F.col("a") + F.col("w") + F.col("e"), F.col("b")
    summed = full.groupBy("nom_produit").agg(
        F.first("debut").alias("debut"), F.max("fin").alias("fin"), F.first("a").alias("a"), F.first("b").alias("b"), F.sum("n").alias("n"),
        F.sum(F.col("y") - c * F.col("n") - b * F.col("t")).alias("r"),
        F.sum(F.col("yy") + c * c * F.col("n") + b * b * F.col("tt") - 2 * c * F.col("y") - 2 * b * F.col("ty") + 2 * c * b * F.col("t")).alias("rr"),
        *[F.coalesce(F.max(F.when(F.col("j") == k, F.col("w"))), F.lit(0.0)).alias(f"w{k}") for k in range(7)],
        *[F.coalesce(F.max(F.when(F.col("m") == k, F.col("e"))), F.lit(0.0)).alias(f"e{k}") for k in range(1, 13)],
        *([F.flatten(F.collect_list("jours")).alias("jours")] if carried else []))
    variance = F.try_divide(F.col("rr") - F.try_divide(F.col("r") * F.col("r"), F.col("n")), F.col("n") - 1)
    return summed.select(
        "nom_produit", "debut", "fin", "a", "b", F.array(*[f"w{k}" for k in range(7)]).alias("effet_semaine"), F.array(*[f"e{k}" for k in range(1, 13)]).alias("effet_mois"),
        (F.lit(z) * F.sqrt(F.greatest(F.coalesce(variance, F.lit(0.0)), F.lit(0.0)))).alias("demi"), *(["jours"] if carried else []))


def with_forecast(rows: DataFrame) -> DataFrame:
    """Rows that hold a day and a product's model, with the model's value and interval for that day."""
    centre = (
        F.col("a") + F.col("b") * F.datediff("ds", "debut") + F.get("effet_semaine", F.weekday("ds")) + F.get("effet_mois", F.month("ds") - 1))
    return rows.withColumn("yhat", centre).withColumns({
        "yhat_lower": F.col("yhat") - F.col("demi"), "yhat_upper": F.col("yhat") + F.col("demi")}).drop("debut", "fin", "a", "b", "effet_semaine", "effet_mois", "demi")


def forecast_native(daily: DataFrame, periods: int = FORECAST_DAYS) -> DataFrame:
    """The days after each product's last one."""
    coming = F.explode(F.sequence(F.date_add("fin", 1), F.date_add("fin", periods)))
    return with_forecast(native_model(dense_daily(daily)).withColumn("ds", coming)).select(FORECAST_COLUMNS)


def yearly_breaks(days: DataFrame, least_days: int = BREAK_YEAR_DAYS) -> DataFrame:
    """Per product how its trend has changed so far: breaks a day (``rythme``) and the mean change of the daily slope (``taille``).

    A break is what lies between the least-squares slopes of two successive years that have ``least_days`` days or more.
    Whatever a year's seasons do to its slope is alike in both. Products with fewer than two such years have none.
    """
    t = F.datediff("ds", F.trunc("ds", "year")).cast("double")
    years = days.groupBy("nom_produit", F.year("ds").alias("an")).agg(F.regr_slope("y", t).alias("pente"), F.count("*").alias("nb"))
    steps = years.where(F.col("nb") >= least_days).withColumn(
        "pas", F.col("pente") - F.lag("pente").over(Window.partitionBy("nom_produit").orderBy("an")))
    return steps.groupBy("nom_produit").agg(
        (F.count("pas") / F.sum("nb")).alias("rythme"), F.coalesce(F.avg(F.abs("pas")), F.lit(0.0)).alias("taille"))


def forecast_native_widening(daily: DataFrame, periods: int = FORECAST_DAYS, z: float = Z_85) -> DataFrame:
    """The native forecast with an interval that widens with the days ahead, by the trend breaks to be expected."""
    days = dense_daily(daily)
    model = native_model(days, z=z).join(yearly_breaks(days), "nom_produit", "left")
    coming = model.withColumn("ds", F.explode(F.sequence(F.date_add("fin", 1), F.date_add("fin", periods))))
    drift = drift_variance(F.coalesce("rythme", F.lit(0.0)), F.coalesce("taille", F.lit(0.0)), F.datediff("ds", "fin"))
    wider = coming.withColumn("demi", F.sqrt(F.col("demi") * F.col("demi") + F.lit(z * z) * drift))
    return with_forecast(wider).select(FORECAST_COLUMNS)


def fit_and_extend(daily: DataFrame, periods: int = FORECAST_DAYS) -> DataFrame:
    """History and future days of each product with the native fit; ``futur`` tells them apart."""
    rows = dense_daily(daily, periods)
    return with_forecast(rows.join(native_model(rows.where(~F.col("futur"))), "nom_produit"))


def forecast_moving_average(
    dense: DataFrame, window: int = RECENT_DAYS, periods: int = FORECAST_DAYS, band: float = FALLBACK_BAND
) -> DataFrame:
    """The mean of the last days, repeated, with a fixed band around it."""
    recent = last_days(dense, window).groupBy("nom_produit").agg(F.avg("y").alias("yhat"), F.max("ds").alias("_fin"))
    days = F.sequence(F.date_add("_fin", 1), F.date_add("_fin", periods))
    return recent.withColumn("ds", F.explode(days)).select(
        "nom_produit", "ds", "yhat",
        (F.col("yhat") * (1 - band)).alias("yhat_lower"),
        (F.col("yhat") * (1 + band)).alias("yhat_upper"),
    )


def _fitted_tests(split: DataFrame, *columns: str) -> DataFrame:
    """Test days of a split series with the forecast of a fit on its training days; products with no such days have none."""
    model = native_model(split, F.col("apprentissage"), ["y", *columns])
    return with_forecast(model.select(*[c for c in model.columns if c != "jours"], F.inline("jours")))


def backtest_native(split: DataFrame) -> DataFrame:
    """Test days of a split series with the forecast of a fit on its training days."""
    return _fitted_tests(split).select("nom_produit", "ds", "y", "yhat", "yhat_lower", "yhat_upper")


def backtest_both(split: DataFrame, window: int = RECENT_DAYS) -> DataFrame:
    """Test days with the forecast of both models, one row per day and model."""
    recent = F.col("apprentissage") & (F.datediff("date_coupure", "ds") < window)
    with_mean = split.withColumn("_recent", F.avg(F.when(recent, F.col("y"))).over(per_product()))
    both = F.array(
        F.struct(F.lit("natif").alias("modele"), F.col("yhat").alias("yhat")),
        F.struct(F.lit("moyenne_mobile").alias("modele"), F.col("_recent").alias("yhat")),
    )
    return _fitted_tests(with_mean, "_recent").select("nom_produit", "ds", "y", F.inline(both))


def history_and_forecast(fitted: DataFrame, days: int = RECENT_DAYS) -> DataFrame:
    """The last days of the history followed by the forecast, one table per product."""
    last_known = F.max(F.when(~F.col("futur"), F.col("ds"))).over(per_product())
    past = ~F.col("futur")
    return (
        fitted.withColumn("_fin", last_known).where(F.col("futur") | (F.datediff("_fin", "ds") < days))
        .select(
            "nom_produit", "ds",
            F.when(past, "historique").otherwise("prevision").alias("nature"),
            F.when(past, F.col("y")).otherwise(F.col("yhat")).alias("valeur"),
            F.when(~past, F.col("yhat_lower")).alias("yhat_lower"),
            F.when(~past, F.col("yhat_upper")).alias("yhat_upper"),
        )
    )
