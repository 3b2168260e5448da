"""Every query by name, wired to the order tables of a folder."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.fixed_values import (
    EVENT_WINDOWS,
    GUIDE_CHANGEPOINT_SHARE,
    REGRESSOR_COLUMNS,
    REGRESSORS_BY_CATEGORY,
    TEST_DAYS,
)
from larder.functions import columns as C
from larder.operators import demand, evaluate, fifo, forecast, quality, replenish, report, ridge, series
from larder.session import TEXT_OPTIONS, materialize, open_folders, scratch_path
from larder.sources import movements as readers
from larder.sources import rejects
from larder.sources import runs as run_store
from larder.sources import sinks
from larder.sources.movements import MOVEMENT_SCHEMA
from larder.sources.sample_tables import CHANGEPOINTS, FOCUS_PRODUCT, movements

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles to 4 digits: sums in another order differ in the last bits."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


# --- inputs, with no more columns than a query reads ----------------------------

DEMAND = ["nom_produit", "date", "type_sortie", "quantite"]
OUTGOING = ["nom_produit", "date", "type_operation", "quantite"]
STOCK = ["nom_produit", "date", "type_operation", "date_expiration", "id_lot", "id_produit", "quantite", "stock_theorique"]


def _consumed(spark, d, *extra):
    return demand.consumed(movements(spark, d, *DEMAND, *extra))


def _outgoing(spark, d, *extra):
    return demand.outgoing(movements(spark, d, *dict.fromkeys([*OUTGOING, *extra])))


def _food(spark, d, *extra):
    return demand.food(movements(spark, d, "nom_produit", "type_produit", "date", "date_expiration", *extra))


def _daily(spark, d):
    return demand.daily_demand(_consumed(spark, d))


def _dense(spark, d):
    return series.dense_daily(_daily(spark, d))


def _daily_regressors(spark, d):
    return demand.daily_demand(_consumed(spark, d, *REGRESSOR_COLUMNS), regressors=True)


def _dense_regressors(spark, d):
    return series.dense_daily_regressors(_daily_regressors(spark, d))


def _stock(spark, d):
    return replenish.stock_and_life(demand.outgoing(movements(spark, d, *STOCK)))


def _split(spark, d):
    return series.with_split(_dense(spark, d), days=TEST_DAYS)


# --- sources --------------------------------------------------------------------


@query
def scan_movements(spark, d):
    return rounded(movements(spark, d))


@query
def scan_movements_csv(spark, d):
    """The same rows, written as CSV and read back with the explicit schema."""
    path = scratch_path(spark, "movements_csv")
    movements(spark, d).write.options(**TEXT_OPTIONS).option("header", True).csv(path)
    return rounded(readers.read_movements(spark, path))


@query
def scan_movements_base(spark, d):
    """The first-generation layout, written as CSV and read back under the current names."""
    path = scratch_path(spark, "movements_base")
    source = movements(spark, d).withColumn("numero_lot", F.concat(F.lit("L"), F.col("id_lot")))
    base = source.drop("temperature").withColumnRenamed("temperature_stockage", "temperature")
    base.select(*[f.name for f in readers.BASE_SCHEMA]).write.options(**TEXT_OPTIONS).option("header", True).csv(path)
    return rounded(readers.read_movements(spark, path, layout="base"))


def _broken_files(spark, d):
    """Files of the first-generation layout, without header, some of whose rows are broken; a folder per operation."""
    source = movements(spark, d).withColumn("numero_lot", F.concat(F.lit("L"), F.col("id_lot")))
    base = source.drop("temperature").withColumnRenamed("temperature_stockage", "temperature")
    names = [f.name for f in readers.BASE_SCHEMA]
    lot = F.col("id_lot")
    broken = {
        "date": F.when(lot % 97 == 0, F.date_format("date", "dd/MM/yyyy")).when(lot % 89 != 0, F.col("date").cast("string")),
        "quantite": F.when(lot % 83 == 0, "douze").otherwise(F.col("quantite").cast("string")),
        "id_fournisseur": F.when(lot % 79 == 0, F.concat(F.lit("F"), F.col("id_fournisseur"))).otherwise(F.col("id_fournisseur").cast("string")),
    }
    line = F.to_csv(F.struct(*[broken.get(c, F.col(c)).alias(c) for c in names]))
    line = F.when(lot % 73 == 0, F.substring_index(line, ",", 9)).when(lot % 71 == 0, F.concat(line, F.lit(",surplus"))).otherwise(line)
    path = scratch_path(spark, "movements_broken")
    with open_folders(spark, 2):
        base.select(F.col("type_operation").alias("dossier"), line.alias("value")).write.options(**TEXT_OPTIONS).partitionBy("dossier").text(path)
    return path


@query
def scan_movements_rejects(spark, d):
    """The good rows of files with broken ones."""
    return rounded(rejects.split_movements(spark, _broken_files(spark, d), "base", header=False)[0])


@query
def movement_rejects(spark, d):
    """The broken rows: folder of the file, raw line, reason, columns and values at fault."""
    _, found = rejects.split_movements(spark, _broken_files(spark, d), "base", header=False)
    return found.withColumn("fichier", F.regexp_extract("fichier", "dossier=([^/]*)/", 1))


@query
def movement_reject_counts(spark, d):
    _, found = rejects.split_movements(spark, _broken_files(spark, d), "base", header=False)
    return rejects.reject_counts(found.withColumn("fichier", F.regexp_extract("fichier", "dossier=([^/]*)/", 1)))


@query
def parse_dates(spark, d):
    """Dates as text, some in another notation or cut short, which are counted as rejects."""
    texts = movements(spark, d, "date", "date_expiration", "id_lot").select(
        F.when(F.col("id_lot") % 97 == 0, F.date_format("date", "dd/MM/yyyy")).otherwise(F.col("date").cast("string")).alias("date"),
        F.when(F.col("id_lot") % 89 == 0, F.substring(F.col("date_expiration").cast("string"), 1, 7)).otherwise(F.col("date_expiration").cast("string")).alias("date_expiration"))
    return readers.date_parse_report(texts, ["date", "date_expiration"])


@query
def schema_check(spark, d):
    """The header of files that lack two columns and have one too many, read back without a schema."""
    path = scratch_path(spark, "movements_header")
    source = movements(spark, d).drop("temperature_stockage", "covid_impact").withColumn("commentaire", F.lit("x"))
    source.write.options(**TEXT_OPTIONS).option("header", True).csv(path)
    return readers.schema_report(spark.read.option("header", True).csv(path))


# --- profiling ------------------------------------------------------------------


@query
def profile_shape(spark, d):
    return quality.shape(movements(spark, d, "quantite"), len(MOVEMENT_SCHEMA))


@query
def profile_info(spark, d):
    return quality.info(movements(spark, d))


@query
def profile_describe(spark, d):
    # Read several times, so the running stock is worked out once.
    mv = movements(spark, d).select([f.name for f in MOVEMENT_SCHEMA if isinstance(f.dataType, T.NumericType)])
    return rounded(quality.describe(materialize(mv, "movements")))


@query
def missing_values(spark, d):
    return quality.missing_values(movements(spark, d))


@query
def period_span(spark, d):
    return rounded(quality.period_span(movements(spark, d, "date")))


@query
def dq_counts(spark, d):
    return quality.consistency_counts(
        movements(spark, d, "quantite", "stock_theorique", "date", "date_expiration"))


@query
def expired_use(spark, d):
    return rounded(quality.expired_use(movements(spark, d, "nom_produit", "date", "date_expiration")))


@query
def expired_rows(spark, d):
    return quality.expired_rows(movements(
        spark, d, "nom_produit", "date", "date_expiration", "id_lot", "id_produit", "quantite"))


LOTS = ["nom_produit", "date", "type_operation", "id_lot", "id_produit", "quantite", "date_expiration"]


@query
def fifo_allocation(spark, d):
    """The lot that each issue should have drawn on, and how much."""
    return rounded(fifo.allocate(movements(spark, d, *LOTS)))


@query
def fifo_violations(spark, d):
    return rounded(fifo.violations(fifo.allocate(movements(spark, d, *LOTS))))


@query
def value_counts_operation(spark, d):
    return quality.value_counts(movements(spark, d, "type_operation"), "type_operation")


@query
def value_counts_type(spark, d):
    return quality.value_counts(movements(spark, d, "type_produit"), "type_produit")


@query
def distinct_counts(spark, d):
    return quality.distinct_counts(movements(spark, d, "id_produit", "id_lot", "id_fournisseur", "id_arrivage"))


@query
def distinct_counts_sketch(spark, d):
    """Whether the counts merged from sketches by month, written and read again, are within 2 % of the exact ones."""
    ids = ["id_produit", "id_lot", "id_fournisseur", "id_arrivage"]
    kept = materialize(quality.distinct_sketches(movements(spark, d, "date", *ids)), "sketches")
    exact = quality.distinct_counts(movements(spark, d, *ids)).select(F.lit(1).alias("cle"), "*")
    merged = quality.merged_counts(kept).select(F.lit(1).alias("cle"), *[F.col(c).alias(f"{c}_estime") for c in quality.DISTINCT_COLUMNS])
    return exact.join(merged, "cle").select(*[
        x for c in quality.DISTINCT_COLUMNS for x in (F.col(c), (F.abs(F.col(f"{c}_estime") - F.col(c)) <= 0.02 * F.col(c)).alias(f"{c}_proche"))])


@query
def regressor_stats(spark, d):
    return rounded(quality.regressor_stats(movements(spark, d, *REGRESSOR_COLUMNS)))


@query
def event_flag_stats(spark, d):
    return rounded(quality.event_flag_stats(movements(spark, d, "date", *REGRESSOR_COLUMNS)))


@query
def split_regressor_coverage(spark, d):
    return series.split_coverage(series.with_split(_dense_regressors(spark, d), days=TEST_DAYS))


@query
def product_names(spark, d):
    return quality.product_names(_outgoing(spark, d), 10)


@query
def product_names_all(spark, d):
    return quality.product_names(movements(spark, d, "nom_produit"))


@query
def operation_shares(spark, d):
    return rounded(quality.operation_shares(movements(spark, d, "type_operation", "type_sortie")))


@query
def waste_rate(spark, d):
    return rounded(quality.waste_rate(movements(spark, d, "type_sortie", "quantite")))


@query
def waste_rate_by_product(spark, d):
    return rounded(quality.waste_rate(movements(spark, d, "nom_produit", "type_sortie", "quantite"), ["nom_produit"]))


@query
def waste_rate_levels(spark, d):
    """Total, by product type and by product, from one scan."""
    return rounded(quality.waste_rate_levels(movements(spark, d, "type_produit", "nom_produit", "type_sortie", "quantite")))


# --- projections and filters ----------------------------------------------------


@query
def calendar_features(spark, d):
    return C.add_calendar(movements(spark, d, "id_lot", "id_produit", "date"))


@query
def shelf_life(spark, d):
    return C.add_shelf_life(movements(spark, d, "id_lot", "id_produit", "date", "date_expiration"))


@query
def perishability_class(spark, d):
    return rounded(demand.shelf_life_by_product(_food(spark, d)).select("nom_produit", "duree_moyenne", "classe"))


@query
def season_flags(spark, d):
    df = movements(spark, d, "id_lot", "id_produit", "date")
    return df.withColumns({
        "saison_froide": C.is_cold_season(F.month("date")),
        "week_end": C.is_weekend(F.weekday("date")),
    })


@query
def product_slug(spark, d):
    names = quality.product_names(movements(spark, d, "nom_produit"))
    return names.select("nom_produit", C.slug("nom_produit").alias("slug"), C.slug("nom_produit", lower=False).alias("slug_casse"))


@query
def outgoing(spark, d):
    return _outgoing(spark, d, "id_lot", "unite")


@query
def food_only(spark, d):
    return _food(spark, d, "id_lot", "quantite")


@query
def product_focus(spark, d):
    return demand.focus(_outgoing(spark, d, "id_lot"), FOCUS_PRODUCT)


@query
def consumption_only(spark, d):
    return _consumed(spark, d, "id_lot")


@query
def perishable_products(spark, d):
    return demand.perishable_products(_food(spark, d))


# --- rankings and seasonality ---------------------------------------------------


@query
def top_products(spark, d):
    return demand.top_products(_outgoing(spark, d, "type_produit", "unite", "id_lot"))


@query
def top_products_by_name(spark, d):
    return demand.top_products(_outgoing(spark, d, "id_lot"), keys=["nom_produit"])


@query
def shelf_life_by_product(spark, d):
    return demand.shelf_life_by_product(_food(spark, d))


@query
def most_perishable(spark, d):
    return rounded(demand.most_perishable(_food(spark, d)))


@query
def monthly_volume(spark, d):
    return demand.monthly_volume(_outgoing(spark, d, "id_lot"))


@query
def monthly_volume_first_year(spark, d):
    return demand.monthly_volume(_outgoing(spark, d, "id_lot"), 12)


@query
def month_seasonality(spark, d):
    return demand.month_seasonality(_outgoing(spark, d))


@query
def seasonal_extremes(spark, d):
    return rounded(demand.seasonal_extremes(_outgoing(spark, d)))


@query
def annual_mean_line(spark, d):
    return rounded(demand.annual_mean_line(_outgoing(spark, d)))


@query
def weekday_pattern(spark, d):
    return demand.weekday_pattern(_outgoing(spark, d))


@query
def weekend_gap(spark, d):
    return rounded(demand.weekend_gap(_outgoing(spark, d)))


@query
def supplier_performance(spark, d):
    return demand.supplier_performance(movements(spark, d, "nom_fournisseur", "id_arrivage", "quantite", "id_produit"))


@query
def top_suppliers(spark, d):
    return demand.supplier_performance(
        movements(spark, d, "nom_fournisseur", "id_arrivage", "quantite", "id_produit"), 3)


@query
def supplier_volume_by_unit(spark, d):
    return demand.supplier_volume_by_unit(movements(spark, d, "nom_fournisseur", "unite", "quantite"))


# --- daily series ---------------------------------------------------------------


@query
def product_card(spark, d):
    return rounded(demand.product_card(_outgoing(spark, d, "date_expiration")))


@query
def daily_demand(spark, d):
    return _daily(spark, d)


@query
def daily_demand_outgoing(spark, d):
    """Demand counted as every outgoing row, destroyed ones included."""
    return demand.daily_demand(_outgoing(spark, d))


@query
def daily_stats(spark, d):
    return rounded(demand.daily_stats(_daily(spark, d)))


@query
def daily_stats_outgoing(spark, d):
    return rounded(demand.daily_stats(demand.daily_demand(_outgoing(spark, d))))


@query
def daily_with_regressors(spark, d):
    return rounded(_daily_regressors(spark, d))


@query
def moving_avg(spark, d):
    return rounded(demand.moving_avg(_daily(spark, d)))


@query
def dense_daily(spark, d):
    return _dense(spark, d)


@query
def dense_daily_regressors(spark, d):
    return rounded(_dense_regressors(spark, d))


@query
def active_days(spark, d):
    return series.active_days(_dense(spark, d))


@query
def last_30_days(spark, d):
    return rounded(series.last_days(_dense(spark, d)))


@query
def holidays(spark, d):
    return series.holidays(_dense_regressors(spark, d))


@query
def holiday_calendar(spark, d):
    return series.holiday_calendar(movements(spark, d, "date", *REGRESSOR_COLUMNS))


@query
def holiday_offsets(spark, d):
    """Days around events, each with its distance from the nearest one."""
    return series.holiday_offsets(_dense_regressors(spark, d), EVENT_WINDOWS)


@query
def holiday_counts(spark, d):
    return series.holiday_counts(series.holidays(_dense_regressors(spark, d)))


@query
def changepoints(spark, d):
    return series.changepoints(_dense(spark, d), CHANGEPOINTS)


@query
def auto_changepoints(spark, d):
    return series.auto_changepoints(_dense(spark, d), share=GUIDE_CHANGEPOINT_SHARE)


@query
def split_80_20(spark, d):
    return rounded(series.split_80_20(_dense(spark, d)))


@query
def split_365(spark, d):
    return rounded(series.split_365(_dense(spark, d)))


@query
def future_frame(spark, d):
    return rounded(series.future_frame(_dense_regressors(spark, d)))


@query
def future_regressors_monthly(spark, d):
    return rounded(series.future_frame(_dense_regressors(spark, d), fill="month").where("futur"))


@query
def fourier_features(spark, d):
    return rounded(series.fourier_features(movements(spark, d, "date"), "date"))


@query
def trend_features(spark, d):
    return series.trend_features(_dense(spark, d), CHANGEPOINTS)


@query
def standardized_regressors(spark, d):
    return rounded(series.standardized_regressors(series.with_split(_dense_regressors(spark, d), days=TEST_DAYS)))


@query
def regressor_choice(spark, d):
    mv = movements(spark, d, "nom_produit", "type_produit", "date", "date_expiration")
    return series.regressor_choice(mv, REGRESSORS_BY_CATEGORY)


# --- forecasts ------------------------------------------------------------------


@query
def forecast_native(spark, d):
    return rounded(forecast.forecast_native(_daily(spark, d)))


@query
def forecast_native_widening(spark, d):
    """The native forecast with an interval that grows with the days ahead."""
    return rounded(forecast.forecast_native_widening(_daily(spark, d)))


@query
def forecast_moving_average(spark, d):
    return rounded(forecast.forecast_moving_average(_dense(spark, d)))


@query
def forecast_summary(spark, d):
    return rounded(evaluate.forecast_summary(forecast.forecast_native(_daily(spark, d))))


@query
def history_and_forecast(spark, d):
    return rounded(forecast.history_and_forecast(forecast.fit_and_extend(_daily(spark, d))))


@query
def backtest_join(spark, d):
    split = _split(spark, d)
    predicted = forecast.backtest_native(split)
    return rounded(evaluate.backtest_join(split.where(~F.col("apprentissage")), predicted))


@query
def forecast_metrics(spark, d):
    return rounded(evaluate.metrics(forecast.backtest_native(_split(spark, d))))


@query
def forecast_verdict(spark, d):
    """Per product; WAPE is judged beside MAPE, which days without demand inflate."""
    scores = evaluate.metrics(forecast.backtest_native(_split(spark, d)))
    return rounded(scores.select(
        "nom_produit", "mape", "wape",
        evaluate.verdict(F.col("mape")).alias("verdict"), evaluate.verdict(F.col("wape")).alias("verdict_wape")))


@query
def model_comparison(spark, d):
    scores = evaluate.metrics(forecast.backtest_both(_split(spark, d)), ["nom_produit", "modele"])
    return rounded(evaluate.ranked(scores))


@query
def model_comparison_enriched(spark, d):
    """The regression among the models compared, on the same test days, blind to them."""
    dense = series.dense_daily_regressors(_daily_regressors(spark, d), train_days=TEST_DAYS)
    pairs = forecast.backtest_both(_split(spark, d)).unionByName(
        ridge.backtest_ridge(dense, CHANGEPOINTS, ENRICHED, blind=True).select("nom_produit", "ds", "y", "modele", "yhat"))
    return rounded(evaluate.ranked(evaluate.metrics(pairs, ["nom_produit", "modele"])))


ENRICHED = ridge.CONFIGS["enrichi"]
PRESETS = [ridge.CONFIGS[n] for n in ("enrichi", "contre_sous_apprentissage", "contre_sur_apprentissage")]


def _fitted(spark, d, predict: Column | None = None):
    return ridge.fit_ridge(ridge.forecast_rows(_dense_regressors(spark, d), CHANGEPOINTS), ENRICHED, predict=predict)


@query
def forecast_ridge(spark, d):
    """Test days of each product, forecast from the days before."""
    return rounded(ridge.backtest_ridge(_dense_regressors(spark, d), CHANGEPOINTS, ENRICHED))


@query
def forecast_ridge_blind(spark, d):
    """The same with only what is known in advance about the test days."""
    dense = series.dense_daily_regressors(_daily_regressors(spark, d), train_days=TEST_DAYS)
    return rounded(ridge.backtest_ridge(dense, CHANGEPOINTS, ENRICHED, blind=True))


@query
def forecast_base(spark, d):
    """Additive model without regressors, trend breaks spread automatically."""
    return rounded(ridge.forecast_ridge(_dense(spark, d), None, ridge.CONFIGS["base"]))


@query
def fit_optimality(spark, d):
    """Whether each fit is at its optimum, checked from features and coefficients: per product and configuration."""
    rich = materialize(ridge.forecast_rows(_dense_regressors(spark, d), CHANGEPOINTS), "model_rows")
    plain = materialize(ridge.forecast_rows(_dense(spark, d), None), "model_rows")
    checks = []
    for rows, configs in ((rich, PRESETS), (plain, [ridge.CONFIGS["base"]])):
        fitted = materialize(ridge.fit_ridge(rows, *configs), "fits")
        settled = fitted.select("nom_produit", "modele", "converge")
        checks += [ridge.optimality(rows, fitted, c).join(settled, ["nom_produit", "modele"]) for c in configs]
    return functools.reduce(DataFrame.unionByName, checks)


SPARSE = [ridge.CONFIGS["enrichi_creux"], ridge.CONFIGS["base_creux"]]


@query
def fit_optimality_sparse(spark, d):
    """The same for fits with Laplace priors on the trend's breaks, zeros included: the subgradient of each coefficient."""
    checks = []
    for dense, dates, config in ((_dense_regressors(spark, d), CHANGEPOINTS, SPARSE[0]), (_dense(spark, d), None, SPARSE[1])):
        rows = materialize(ridge.forecast_rows(dense, dates), "model_rows")
        fitted = materialize(ridge.fit_ridge(rows, config), "fits")
        checks.append(ridge.optimality(rows, fitted, config).join(fitted.select("nom_produit", "modele", "converge"), ["nom_produit", "modele"]))
    return functools.reduce(DataFrame.unionByName, checks)


@query
def forecast_sparse(spark, d):
    """Additive model without regressors, whose automatic trend breaks are mostly 0."""
    return rounded(ridge.forecast_ridge(_dense(spark, d), None, SPARSE[1]))


@query
def trend_breaks(spark, d):
    """The breaks that are not 0, and the change of the daily slope at each."""
    return ridge.trend_breaks(ridge.fit_ridge(ridge.forecast_rows(_dense(spark, d), None), SPARSE[1]))


@query
def forecast_28d(spark, d):
    return rounded(ridge.forecast_ridge(_dense_regressors(spark, d), CHANGEPOINTS))


@query
def forecast_28d_widening(spark, d):
    """The same with an interval that grows with the days ahead."""
    return rounded(ridge.forecast_ridge(_dense_regressors(spark, d), CHANGEPOINTS, widening=True))


@query
def forecast_28d_known_events(spark, d):
    """The same with the coming events given, here those of the year before moved on."""
    dense = _dense_regressors(spark, d)
    known = series.holiday_calendar(movements(spark, d, "date", *REGRESSOR_COLUMNS))
    coming = known.select(F.add_months("ds", 12).alias("ds"), "holiday")
    return rounded(ridge.forecast_ridge(dense, CHANGEPOINTS, events=coming))


def _windowed(spark, d):
    return ridge.forecast_rows(_dense_regressors(spark, d), CHANGEPOINTS, windows=EVENT_WINDOWS)


@query
def forecast_28d_event_windows(spark, d):
    """The same with effects of their own for the days around events."""
    return rounded(ridge.forecast_ridge(_dense_regressors(spark, d), CHANGEPOINTS, windows=EVENT_WINDOWS))


@query
def event_effects(spark, d):
    """Effect of each event by days before and after it."""
    return rounded(ridge.event_effects(ridge.fit_ridge(_windowed(spark, d), ENRICHED), EVENT_WINDOWS))


@query
def fit_optimality_event_windows(spark, d):
    """Whether the fits with effects around events are at their optimum."""
    rows = materialize(_windowed(spark, d), "model_rows")
    fitted = materialize(ridge.fit_ridge(rows, ENRICHED), "fits")
    return ridge.optimality(rows, fitted, ENRICHED, windows=EVENT_WINDOWS).join(fitted.select("nom_produit", "modele", "converge"), ["nom_produit", "modele"])


@query
def regressor_coefficients(spark, d):
    return rounded(ridge.regressor_coefficients(_fitted(spark, d)))


@query
def forecast_components(spark, d):
    return rounded(ridge.components(_fitted(spark, d, predict=F.lit(True))))


@query
def changepoint_effects(spark, d):
    return ridge.changepoint_effects(_fitted(spark, d), CHANGEPOINTS)


@query
def model_presets(spark, d):
    pairs = ridge.backtest_ridge(_dense_regressors(spark, d), CHANGEPOINTS, *PRESETS)
    return rounded(evaluate.ranked(evaluate.metrics(pairs, ["nom_produit", "modele", "converge"])))


@query
def model_presets_origins(spark, d):
    """The configurations scored at three cut dates a year apart, and their mean rank over them."""
    dense = materialize(_dense_regressors(spark, d), "dense_days")
    scores = evaluate.metrics(ridge.backtest_origins(dense, CHANGEPOINTS, *PRESETS), ["nom_produit", "date_coupure", "modele", "converge"])
    return rounded(evaluate.over_origins(scores))


# --- replenishment --------------------------------------------------------------


@query
def current_stock(spark, d):
    return _stock(spark, d).select("nom_produit", "stock_actuel")


@query
def order_horizon(spark, d):
    life = _outgoing(spark, d, "date_expiration").groupBy("nom_produit").agg(F.avg(C.shelf_life()).alias("duree_vie_moyenne"))
    return rounded(life.withColumn("horizon", replenish.order_horizon(F.col("duree_vie_moyenne"))))


@query
def order_recommendation(spark, d):
    return rounded(replenish.order_recommendation(
        forecast.forecast_moving_average(_dense(spark, d)), _stock(spark, d)))


@query
def order_recommendation_native(spark, d):
    return rounded(replenish.order_recommendation(forecast.forecast_native(_daily(spark, d)), _stock(spark, d)))


def _enriched(spark, d):
    return ridge.forecast_ridge(_dense_regressors(spark, d), CHANGEPOINTS)


@query
def order_recommendation_enriched(spark, d):
    return rounded(replenish.order_recommendation(_enriched(spark, d), _stock(spark, d)))


@query
def stock_unknown(spark, d):
    """Order figures where some products' stock was never written down (here those of the fresh parts): it stays unknown."""
    written = F.when(~F.col("nom_produit").endswith("ring"), F.col("stock_theorique"))
    stock = replenish.stock_and_life(demand.outgoing(movements(spark, d, *STOCK).withColumn("stock_theorique", written)))
    found = replenish.replenishment(forecast.forecast_moving_average(_dense(spark, d)), stock)
    return rounded(found.select(
        "nom_produit", "stock_actuel", "besoin", "commande_suggeree", "duree_stock_jours", "risque_gaspillage", "pct_risque", "statut_stock", "actions"))


@query
def stock_cover(spark, d):
    return rounded(replenish.stock_cover(forecast.forecast_moving_average(_dense(spark, d)), _stock(spark, d)))


@query
def waste_risk(spark, d):
    return rounded(replenish.waste_risk(forecast.forecast_moving_average(_dense(spark, d)), _stock(spark, d)))


@query
def weekly_order_safety_stock(spark, d):
    return rounded(replenish.weekly_order_safety_stock(forecast.forecast_native(_daily(spark, d))))


def _summary(spark, d):
    daily = _daily(spark, d)
    split = series.with_split(series.dense_daily(daily), days=TEST_DAYS)
    return report.product_summary(
        daily, forecast.forecast_native(daily), _stock(spark, d), evaluate.metrics(forecast.backtest_native(split)))


@query
def product_summary(spark, d):
    return rounded(_summary(spark, d))


# --- exports and runs -----------------------------------------------------------

# Ids of the runs written by the queries below.
FIRST_RUN, SECOND_RUN = "20250101_080000", "20250102_080000"


def _export(spark, d):
    units = sinks.product_units(movements(spark, d, "nom_produit", "unite"))
    return sinks.forecast_export(forecast.forecast_native(_daily(spark, d)), units)


@query
def forecast_export(spark, d):
    """Published forecast, written as CSV and read back."""
    base = scratch_path(spark, "runs")
    run_store.write_run(_export(spark, d), base, "predictions", FIRST_RUN, "csv")
    return run_store.read_table(spark, base, "predictions", "csv", sinks.FORECAST_CSV_SCHEMA)


@query
def forecast_export_enriched(spark, d):
    """The regression's forecast, unrounded, written as CSV and read back."""
    base = scratch_path(spark, "runs")
    units = sinks.product_units(movements(spark, d, "nom_produit", "unite"))
    run_store.write_run(sinks.forecast_export(_enriched(spark, d), units, rounded=False), base, "predictions", FIRST_RUN, "csv")
    return rounded(run_store.read_table(spark, base, "predictions", "csv", sinks.FORECAST_CSV_SCHEMA))


def _documents(spark, documents):
    base = scratch_path(spark, "runs")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    run_store.write_run(documents, base, "resumes", FIRST_RUN, "json")
    back = run_store.read_table(spark, base, "resumes", "json", schema)
    return back.select(
        "produit", F.to_timestamp("date_analyse").isNotNull().alias("date_analyse_lisible"),
        "dataset.*", "periode_historique.*", "statistiques.*", "performance_modele.*",
        F.concat_ws(",", "configuration_modele.holidays").alias("holidays"),
        F.col("configuration_modele.nb_holidays").alias("nb_holidays"),
        F.concat_ws(",", "configuration_modele.changepoints").alias("changepoints"),
        F.col("configuration_modele.nb_changepoints").alias("nb_changepoints"),
        F.concat_ws(",", "configuration_modele.regresseurs").alias("regresseurs"),
        "configuration_modele.seasonality.*", "predictions.*", "recommandations.*",
    )


def _every_row(spark, d):
    return movements(spark, d, "date").agg(
        F.count("*").alias("nb_lignes"), F.min("date").alias("debut"), F.max("date").alias("fin"))


@query
def summary_export(spark, d):
    """Nested summary documents of the native model, written as JSON and read back."""
    return _documents(spark, report.nested_summary(_summary(spark, d), "natif", dataset=_every_row(spark, d)))


@query
def summary_export_enriched(spark, d):
    """The same of the regression, with its configuration."""
    dense = _dense_regressors(spark, d)
    blind = series.dense_daily_regressors(_daily_regressors(spark, d), train_days=TEST_DAYS)
    scores = evaluate.metrics(ridge.backtest_ridge(blind, CHANGEPOINTS, ENRICHED, blind=True))
    summary = report.product_summary(_daily(spark, d), ridge.forecast_ridge(dense, CHANGEPOINTS), _stock(spark, d), scores)
    return _documents(spark, report.nested_summary(
        summary, "enrichi", changepoints=CHANGEPOINTS, dataset=_every_row(spark, d), events=series.holidays(dense), model=ENRICHED))


def _two_runs(spark, d):
    base = scratch_path(spark, "runs")
    average = forecast.forecast_moving_average(_dense(spark, d))
    units = sinks.product_units(movements(spark, d, "nom_produit", "unite"))
    run_store.write_run(_export(spark, d), base, "predictions", FIRST_RUN, "csv", files=1)
    run_store.write_run(sinks.forecast_export(average, units), base, "predictions", SECOND_RUN, "csv", files=1)
    totals = evaluate.forecast_summary(average)
    run_store.write_run(totals, base, "totaux", SECOND_RUN, "json", files=1)
    run_store.write_run(run_store.as_text(run_store.summary_lines(totals)), base, "resume", SECOND_RUN, "text", files=1)
    return base


def _predictions(spark, base):
    return run_store.read_table(spark, base, "predictions", "csv", sinks.FORECAST_CSV_SCHEMA)


@query
def runs(spark, d):
    """Two runs in one table: forecast days and products of each."""
    base = _two_runs(spark, d)
    return _predictions(spark, base).groupBy("run_id").agg(
        F.count("*").alias("nb_lignes"), F.count_distinct("produit").alias("nb_produits"))


@query
def run_summary(spark, d):
    """Key/value lines of a run's forecast totals."""
    average = forecast.forecast_moving_average(_dense(spark, d))
    return run_store.summary_lines(evaluate.forecast_summary(average).transform(rounded))


@query
def run_files(spark, d):
    """Tables of each run and the kind of their files."""
    # Part files and their sizes depend on the cluster.
    return run_store.run_files(spark, _two_runs(spark, d)).select("run_id", "table", "type").distinct()


@query
def run_text(spark, d):
    """The key/value text of a run, read back and split again."""
    lines = spark.read.text(f"{_two_runs(spark, d)}/resume").select("run_id", "value")
    pair = F.regexp_extract_all("value", F.lit(r"^(.*) \| (\w+): (.*)$"), F.lit(0))
    return lines.where(F.size(pair) == 1).groupBy("run_id").agg(
        F.count("*").alias("nb_lignes"),
        F.count_distinct(F.regexp_extract("value", r"^(.*) \| \w+: ", 1)).alias("nb_produits"),
        F.count_distinct(F.regexp_extract("value", r" \| (\w+): ", 1)).alias("nb_cles"))


@query
def run_history(spark, d):
    base = _two_runs(spark, d)
    # Only the size is left out: it depends on how the writer compresses and quotes.
    return run_store.run_history(spark, base, _predictions(spark, base)).drop("taille_ko")
