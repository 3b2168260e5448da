"""Per-product regression with trend breaks, seasons, event days and outside regressors.

    y = trend * (1 + yearly + weekly + events) + regressors      (multiplicative)
    y = trend + yearly + weekly + events + regressors            (additive)

Spark builds the features, keyed by product, and turns the fitted parts into
forecasts, intervals and scores. Only the linear algebra of one product's days
runs in Python.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from larder.fixed_values import (
    AUTO_CHANGEPOINT_SHARE,
    AUTO_CHANGEPOINTS,
    FLU_MONTHS,
    FORECAST_DAYS,
    HOLIDAY_FLAGS,
    MODEL_CONFIGS,
    MODEL_REGRESSORS,
    SPARSE_CONFIGS,
    TEST_DAYS,
    TREND_PRIOR,
    WEEK_PERIOD,
    YEAR_PERIOD,
    Z_85,
)
from larder.functions import solver
from larder.functions.columns import drift_variance
from larder.functions.solver import Config
from larder.operators.series import (
    NO_WINDOWS,
    EventWindows,
    auto_changepoint,
    day_number,
    event_offset,
    event_terms,
    future_frame,
    per_product,
    regressor_scales,
    with_split,
)

# Executors get the solver with the task and need no installed copy of it.
cloudpickle.register_pickle_by_value(solver)

REGRESSORS = [name for name, _, _ in MODEL_REGRESSORS]
CONFIGS = {row[0]: Config(*row) for row in [*MODEL_CONFIGS, *SPARSE_CONFIGS]}


# --- features -------------------------------------------------------------------


def _hinges(train_end: Column, dates: Sequence[str] | None) -> Column:
    """Days since each trend break, 0 before it; breaks outside the training days stay 0."""
    start = F.col("_debut")
    if dates is not None:
        breaks = F.array(*[F.lit(d).cast("date") for d in dates])
    else:
        # Evenly spread over the leading share of the training days.
        head = F.floor((F.datediff(train_end, start) + 1) * F.lit(AUTO_CHANGEPOINT_SHARE))
        n = F.least(F.lit(AUTO_CHANGEPOINTS), head - 1)
        breaks = F.transform(
            F.sequence(F.lit(1), F.lit(AUTO_CHANGEPOINTS)),
            # Short histories have fewer breaks: the rest of the list stays null, which is no break.
            lambda j: F.when(j <= n, auto_changepoint(start, head, n, j)),
        )

    def hinge(day):
        since = F.greatest(F.datediff("ds", day), F.lit(0)) / F.col("_duree")
        return F.when((day > start) & (day < train_end), since).otherwise(0.0)

    return F.transform(breaks, hinge)


def _doubles(values: Sequence[Column]) -> Column:
    return F.array(*values).cast("array<double>")


def _event_columns(known: Callable[[Column], Column], windows: EventWindows) -> list[Column]:
    """1.0 on the days of each effect of ``event_terms``, else 0.0. Events that are not known have no days around them."""
    terms, columns = event_terms(windows), []
    for label, flag in HOLIDAY_FLAGS:
        offsets = [offset for name, offset in terms if name == label]
        seen = known(F.col(flag).cast("double"))
        if offsets == [0]:
            columns.append(seen)
        else:
            place = event_offset(seen, offsets)
            columns += [F.when(place == offset, 1.0).otherwise(0.0) for offset in offsets]
    return columns


def model_rows(
    rows: DataFrame, train: Column, dates: Sequence[str] | None, blind: bool = False, windows: EventWindows = NO_WINDOWS
) -> DataFrame:
    """Model input for every row of ``rows``: time, breaks, events and scaled regressors.

    ``dates`` are the trend breaks, spread evenly when None. With ``blind`` the
    rows outside the training days get what would be known of them in advance:
    mean regressors, no events, and flu by the months of ``future_frame``. With
    ``windows`` the days around an event have effects of their own, one per offset.
    """
    end = F.max(F.when(train, F.col("ds"))).over(per_product())
    based = rows.withColumns({
        "appris": train,
        "_debut": F.min("ds").over(per_product()),
        "_fin_appris": end,
    }).withColumn("_duree", F.greatest(F.datediff("_fin_appris", "_debut"), F.lit(1)).cast("double"))
    with_outside = set(REGRESSORS) <= set(rows.columns)
    scales = regressor_scales(F.col("appris")) if with_outside else {}
    based = based.withColumns({
        "centres": _doubles([centre for centre, _ in scales.values()]),
        "echelles": _doubles([scale for _, scale in scales.values()]),
    })

    def known(value: Column) -> Column:
        return F.when(F.col("appris"), value).otherwise(0.0) if blind else value

    events = _event_columns(known, windows) if with_outside else []
    outside = []
    for i, (name, _, scaled) in enumerate(MODEL_REGRESSORS if with_outside else []):
        value = (F.col(name) - F.get("centres", F.lit(i))) / F.get("echelles", F.lit(i))
        if blind and not scaled:
            value = F.when(F.col("appris"), value).otherwise(F.month("ds").isin(FLU_MONTHS).cast("double"))
        outside.append(known(value) if scaled else value)
    keep = [c for c in ("futur", "y") if c in rows.columns]
    return based.select(
        "nom_produit", "ds", "appris", *keep,
        (F.datediff("ds", "_debut") / F.col("_duree")).alias("t"),
        day_number("ds").alias("jour"),
        _hinges(F.col("_fin_appris"), dates).alias("ruptures"),
        _doubles([F.coalesce(e, F.lit(0.0)) for e in events]).alias("evenements"),
        _doubles([F.coalesce(r, F.lit(0.0)) for r in outside]).alias("regresseurs"),
        "centres", "echelles",
    )


def forecast_rows(
    dense: DataFrame, dates: Sequence[str] | None, periods: int = FORECAST_DAYS, fill: str = "mean",
    events: DataFrame | None = None, windows: EventWindows = NO_WINDOWS,
) -> DataFrame:
    """All history for training, then the future days."""
    return model_rows(future_frame(dense, periods, fill, events), ~F.col("futur"), dates, windows=windows)


def backtest_rows(
    dense: DataFrame, dates: Sequence[str] | None, days: int = TEST_DAYS, blind: bool = False, windows: EventWindows = NO_WINDOWS
) -> DataFrame:
    """All but the last days for training, those for testing."""
    return model_rows(with_split(dense, days=days), F.col("apprentissage"), dates, blind, windows)


# --- fit: one product's days at a time ------------------------------------------

FIT_COLUMNS = from_arrow_schema(solver.FIT_SCHEMA)


def fit_ridge(rows: DataFrame, *configs: Config, predict: Column | None = None) -> DataFrame:
    """Coefficients per product and configuration, with the evaluated days in ``jours``.

    Fitting uses the rows marked ``appris``; the rows meeting ``predict`` are
    evaluated in the same pass, so the series is built once. A group is one
    product's days, never its movements: the calendar bounds its size.
    """
    inputs = rows.select(
        "nom_produit", "ds", "y", "appris", F.coalesce(F.lit(False) if predict is None else predict, F.lit(False)).alias("predit"),
        "t", "jour", "ruptures", "evenements", "regresseurs", "centres", "echelles",
    )
    return inputs.groupBy("nom_produit").applyInArrow(solver.fit_group(configs), FIT_COLUMNS)


def components(fitted: DataFrame, z: float = Z_85, widening: bool = False) -> DataFrame:
    """Forecast of the evaluated days with its parts: trend, yearly, weekly, events, regressors.

    Each part has the interval that the joint covariance of its coefficients gives it (``tendance_lower``, ``tendance_upper``
    and so on). That of the forecast has the width of the residuals. With ``widening`` it grows after the last training day by what the trend may
    do, if breaks go on as frequent and as large as those in the fit.
    """
    season = F.col("annuel") + F.col("hebdo") + F.col("feries")
    centre = F.when(F.col("multiplicatif"), F.col("tendance") * (1 + season)).otherwise(F.col("tendance") + season)
    breaks = F.slice("tendance", 3, F.greatest(F.size("tendance") - 2, F.lit(0)))
    size = F.try_divide(F.aggregate(breaks, F.lit(0.0), lambda total, b: total + F.abs(b)), F.size(breaks) * F.col("duree"))
    per_fit = fitted.select(
        "nom_produit", "modele", "multiplicatif", "converge", "sigma", (F.size(breaks) / F.col("duree")).alias("_rythme"),
        F.coalesce(size, F.lit(0.0)).alias("_taille"), F.date_add("debut", F.col("duree")).alias("_fin"), F.inline("jours"))
    level = F.when(F.col("multiplicatif"), 1 + season).otherwise(1.0)
    drift = drift_variance(F.col("_rythme"), F.col("_taille"), F.datediff("ds", "_fin")) * level * level
    spread = F.sqrt(F.col("sigma") * F.col("sigma") + drift) if widening else F.col("sigma")
    return (
        per_fit.withColumn("yhat", centre + F.col("effet_regresseurs"))
        .withColumn("yhat_lower", F.col("yhat") - F.lit(z) * spread)
        .withColumn("yhat_upper", F.col("yhat") + F.lit(z) * spread)
        .withColumns({f"{p}_lower": F.col(p) - F.lit(z) * F.col(f"{p}_ecart") for p in solver.PARTS})
        .withColumns({f"{p}_upper": F.col(p) + F.lit(z) * F.col(f"{p}_ecart") for p in solver.PARTS})
        .drop("sigma", "_rythme", "_taille", "_fin", *[f"{p}_ecart" for p in solver.PARTS])
    )


def forecast_ridge(
    dense: DataFrame, dates: Sequence[str] | None, config: Config = CONFIGS["enrichi"],
    periods: int = FORECAST_DAYS, fill: str = "mean", events: DataFrame | None = None, widening: bool = False,
    windows: EventWindows = NO_WINDOWS,
) -> DataFrame:
    """Fit on the whole history, forecast of the days after it."""
    fitted = fit_ridge(forecast_rows(dense, dates, periods, fill, events, windows), config, predict=F.col("futur"))
    return components(fitted, widening=widening).select("nom_produit", "ds", "yhat", "yhat_lower", "yhat_upper", "converge")


def backtest_ridge(
    dense: DataFrame, dates: Sequence[str] | None, *configs: Config, days: int = TEST_DAYS, blind: bool = False,
    windows: EventWindows = NO_WINDOWS,
) -> DataFrame:
    """Test days with the forecast of a fit on the days before, per configuration."""
    fitted = fit_ridge(backtest_rows(dense, dates, days, blind, windows), *configs, predict=~F.col("appris"))
    return components(fitted).select("nom_produit", "modele", "ds", "y", "yhat", "yhat_lower", "yhat_upper", "converge")


def backtest_origins(
    dense: DataFrame, dates: Sequence[str] | None, *configs: Config, origins: int = 3, days: int = TEST_DAYS, blind: bool = False
) -> DataFrame:
    """``backtest_ridge`` at several cut dates, ``days`` apart, the latest ``days`` before the end; ``date_coupure`` names the cut.

    The fits of a cut see no day after it. The series is read once per cut: write it first. A product has no rows for cuts
    that leave it no training day.
    """
    last = F.max("ds").over(per_product())
    ended = dense.withColumn("_fin", last)
    parts = []
    for step in range(origins):
        known = ended.where(F.col("ds") <= F.date_sub("_fin", step * days))
        cuts = known.groupBy("nom_produit").agg(F.date_sub(F.max("ds"), days).alias("date_coupure"))
        pairs = backtest_ridge(known.drop("_fin"), dates, *configs, days=days, blind=blind)
        parts.append(pairs.join(cuts, "nom_produit"))
    return functools.reduce(DataFrame.unionByName, parts)


def event_effects(fitted: DataFrame, windows: EventWindows = NO_WINDOWS, z: float = Z_85) -> DataFrame:
    """Effect of each event on its own day and on those around it, with its interval.

    A share of the trend in multiplicative models, a quantity in additive ones. Effects of offsets that no training day has are 0
    with the interval of their prior.
    """
    lines = F.arrays_zip(
        F.array(*[F.struct(F.lit(label).alias("holiday"), F.lit(offset).alias("offset")) for label, offset in event_terms(windows)]).alias("terme"),
        F.col("evenements").alias("effet"), F.col("evenements_ecart").alias("ecart"))
    return fitted.select("nom_produit", "modele", "converge", F.inline(lines)).select(
        "nom_produit", "modele", "terme.holiday", "terme.offset", "effet",
        (F.col("effet") - F.lit(z) * F.col("ecart")).alias("effet_lower"), (F.col("effet") + F.lit(z) * F.col("ecart")).alias("effet_upper"),
        "converge")


def regressor_coefficients(fitted: DataFrame, z: float = Z_85) -> DataFrame:
    """Effect of one unit of each regressor, with its interval and direction."""
    lines = F.arrays_zip(
        F.array(*[F.lit(r) for r in REGRESSORS]).alias("regresseur"), F.col("centres").alias("centre"),
        F.col("regresseurs").alias("b"), F.col("regresseurs_ecart").alias("e"), F.col("echelles").alias("s"),
    )
    per_unit = fitted.select("nom_produit", "modele", "converge", F.inline(lines)).withColumns({
        "coef": F.col("b") / F.col("s"), "_demi": F.lit(z) * F.col("e") / F.col("s"),
    })
    return per_unit.select(
        "nom_produit", "modele", "regresseur", "centre", "coef",
        (F.col("coef") - F.col("_demi")).alias("coef_lower"),
        (F.col("coef") + F.col("_demi")).alias("coef_upper"),
        F.when(F.col("coef") > 0, "positif").otherwise("negatif").alias("effet"), "converge",
    )


def trend_breaks(fitted: DataFrame, share: float = AUTO_CHANGEPOINT_SHARE) -> DataFrame:
    """Breaks that a fit with automatic dates keeps away from 0: when, and the change of the daily slope."""
    head = F.floor((F.col("duree") + 1) * F.lit(share))
    n = F.least(F.lit(AUTO_CHANGEPOINTS), head - 1)
    kept = fitted.select("nom_produit", "modele", "converge", "debut", "duree", head.alias("_tete"), n.alias("_nb"), F.posexplode(F.slice("tendance", 3, AUTO_CHANGEPOINTS)).alias("place", "b"))
    return kept.where("b <> 0").select(
        "nom_produit", "modele", auto_changepoint(F.col("debut"), F.col("_tete"), F.col("_nb"), F.col("place") + 1).alias("changepoint"),
        (F.col("b") / F.col("duree")).alias("delta"), "converge")


def changepoint_effects(fitted: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Change of the daily trend slope at each known date inside the training days."""
    lines = F.arrays_zip(
        F.array(*[F.lit(d).cast("date") for d in dates]).alias("changepoint"),
        F.slice("tendance", 3, len(dates)).alias("b"),
    )
    inside = (F.col("changepoint") > F.col("debut")) & (F.col("changepoint") < F.date_add("debut", F.col("duree")))
    return (
        fitted.select("nom_produit", "modele", "converge", "debut", "duree", F.inline(lines)).where(inside)
        .select("nom_produit", "modele", "changepoint", (F.col("b") / F.col("duree")).alias("delta"), "converge")
    )


def optimality(
    rows: DataFrame, fitted: DataFrame, config: Config, tolerance: float = 1e-4, windows: EventWindows = NO_WINDOWS
) -> DataFrame:
    """Per product: whether the slope of the penalised squares is 0 in every coefficient, worked out anew from the features.

    A coefficient is at its optimum when its slope, over the square root of its curvature, is below ``tolerance``: it is
    then within that share of its own standard deviation. The variance must be that of the residuals. With Laplace priors
    a break at 0 is at its optimum when the squares pull it no harder than the prior holds it.
    """
    def waves(order: int, period: float) -> list[Column]:
        angles = [F.lit(2.0 * k) * F.pi() * F.col("jour") / F.lit(period) for k in range(1, order + 1)]
        return [f(a) for a in angles for f in (F.sin, F.cos)]

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)

    def leading(name: str, n: int) -> Column:
        return F.slice(F.col(name), 1, n)

    outside, n_events = config.outside, len(event_terms(windows)) if config.outside else 0
    model = fitted.where(F.col("modele") == config.name).select(
        "nom_produit", "variance", "echelle_y", F.col("tendance").alias("b_tendance"),
        F.concat(leading("annuel", 2 * config.yearly), leading("hebdo", 2 * config.weekly), leading("evenements", n_events)).alias("b_saison"),
        leading("regresseurs", len(REGRESSORS) if outside else 0).alias("b_dehors"))
    days = rows.where("appris").join(model, "nom_produit")
    scale = F.col("echelle_y")
    features = days.select(
        "nom_produit", "variance", (F.col("y") / scale).alias("y"),
        F.concat(F.array(F.lit(1.0), F.col("t")), "ruptures").alias("tendance"),
        F.concat(F.array(*waves(config.yearly, YEAR_PERIOD), *waves(config.weekly, WEEK_PERIOD)), *(["evenements"] if outside else [])).alias("saison"),
        (F.col("regresseurs") if outside else _doubles([])).alias("dehors"),
        F.transform("b_tendance", lambda b: b / scale).alias("b_tendance"),
        (F.col("b_saison") if config.multiplicative else F.transform("b_saison", lambda b: b / scale)).alias("b_saison"),
        F.transform("b_dehors", lambda b: b / scale).alias("b_dehors"))
    level, season = dot(F.col("tendance"), F.col("b_tendance")), dot(F.col("saison"), F.col("b_saison"))
    fit = (level * (1 + season) if config.multiplicative else level + season) + dot(F.col("dehors"), F.col("b_dehors"))
    valued = features.withColumns({"niveau": level, "saison_jour": season, "reste": F.col("y") - fit})
    if config.multiplicative:
        slopes = F.concat(F.transform("tendance", lambda x: x * (1 + F.col("saison_jour"))), F.transform("saison", lambda x: x * F.col("niveau")), "dehors")
    else:
        slopes = F.concat("tendance", "saison", "dehors")
    priors = F.concat(
        F.transform("tendance", lambda _, i: F.when(i < 2, F.lit(TREND_PRIOR)).otherwise(F.lit(config.changepoint_prior))),
        F.array_repeat(F.lit(config.seasonality_prior), 2 * (config.yearly + config.weekly)),
        F.array_repeat(F.lit(config.holidays_prior), n_events),
        _doubles([F.lit(float(prior)) for _, prior, _ in MODEL_REGRESSORS] if outside else []))
    lines = valued.select("nom_produit", "variance", "reste", F.size("tendance").alias("nb_tendance"), F.inline(F.arrays_zip(
        slopes.alias("pente"), F.concat("b_tendance", "b_saison", "b_dehors").alias("b"), priors.alias("ecart"),
        F.sequence(F.lit(1), F.size(slopes)).alias("rang"))))
    per_coefficient = lines.groupBy("nom_produit", "rang").agg(
        F.first("b").alias("b"), F.first("ecart").alias("ecart"), F.first("nb_tendance").alias("nb_tendance"),
        (F.sum(F.col("pente") * F.col("reste")) / F.first("variance")).alias("poussee"),
        (F.sum(F.col("pente") * F.col("pente")) / F.first("variance")).alias("courbure"),
        (F.avg(F.col("reste") * F.col("reste")) / F.first("variance")).alias("bruit"))
    weight = 1 / (F.col("ecart") * F.col("ecart"))
    off = F.abs(weight * F.col("b") - F.col("poussee")) / F.sqrt(F.col("courbure") + weight)
    if config.sparse:
        hold, unit = 1 / F.col("ecart"), F.sqrt(F.greatest("courbure", F.lit(1.0)))
        held = F.greatest(F.abs("poussee") - hold, F.lit(0.0)) / unit
        is_break = (F.col("rang") > 2) & (F.col("rang") <= F.col("nb_tendance"))
        off = F.when(is_break & (F.col("b") == 0), held).when(is_break, F.abs(F.col("poussee") - hold * F.signum("b")) / unit).otherwise(off)
    return per_coefficient.groupBy("nom_produit").agg(((F.max(off) < tolerance) & (F.abs(F.max("bruit") - 1) < tolerance)).alias("optimal")).withColumn("modele", F.lit(config.name))
