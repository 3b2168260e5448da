"""Daily series without gaps, calendar features, splits and future days.

Every function here works per product. ``dense_daily`` leaves the rows clustered
by product, and all windows below use that clustering: preparing a series costs
one shuffle by product, of daily rows, however many steps follow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from larder.fixed_values import (
    AUTO_CHANGEPOINT_SHARE,
    AUTO_CHANGEPOINTS,
    CLEANING,
    FLAG_REGRESSORS,
    FLU_MONTHS,
    FORECAST_DAYS,
    HOLIDAY_FLAGS,
    MEAN_REGRESSORS,
    MODEL_REGRESSORS,
    TEST_DAYS,
    TEST_SHARE,
    WEEK_PERIOD,
    WEEKLY_ORDER,
    YEAR_PERIOD,
    YEARLY_ORDER,
)
from larder.functions.columns import perishability, shelf_life, with_keys

EPOCH = "1970-01-01"


def per_product() -> WindowSpec:
    return Window.partitionBy("nom_produit")


def _days(end: str | Column, start: str | Column) -> Column:
    return F.datediff(end, start)


# --- gap filling --------------------------------------------------------------


def _calendar(daily: DataFrame, periods: int = 0) -> DataFrame:
    """Each product's days from its first to its last, plus ``periods`` days after.

    A day with demand also opens the days up to the product's next one, so the
    calendar needs no join: ``_jour`` is the day with demand, ``ds`` the day itself.
    """
    following = F.lead("date").over(per_product().orderBy("date"))
    last = F.when(following.isNull(), F.date_add("date", periods)).otherwise(F.date_sub(following, 1))
    return (
        daily.withColumns({"_fin": last, "_dernier": following.isNull()})
        .withColumn("ds", F.explode(F.sequence("date", "_fin")))
        .withColumn("futur", F.col("_dernier") & (F.col("ds") > F.col("date")))
        .withColumn("_observe", F.col("ds") == F.col("date"))
    )


def dense_daily(daily: DataFrame, periods: int = 0) -> DataFrame:
    """One row per product and day; days without demand get 0.

    With ``periods`` the days after the last one are added, ``futur`` set and
    ``y`` null.
    """
    demand = F.when(F.col("_observe"), F.col("quantite")).when(~F.col("futur"), 0.0)
    columns = ["nom_produit", "ds", demand.alias("y")]
    return _calendar(daily, periods).select(*columns, *(["futur"] if periods else []))


def dense_daily_regressors(daily: DataFrame, train_days: int | None = None) -> DataFrame:
    """Gap-filled series with regressors: means for continuous ones, 0 for flags.

    Means are over the product's days that have a value. ``train_days`` keeps the
    last days out of the means, for backtests that must not see them.
    """
    rows = _calendar(daily)
    seen = F.col("_observe")
    if train_days is not None:
        rows = rows.withColumn("_bord", F.date_sub(F.max("ds").over(per_product()), train_days))
        usable = seen & (F.col("ds") <= F.col("_bord"))
    else:
        usable = seen
    filled = {c: F.coalesce(F.when(seen, F.col(c)), F.avg(F.when(usable, F.col(c))).over(per_product())) for c in MEAN_REGRESSORS}
    filled |= {c: F.when(seen, F.coalesce(F.col(c), F.lit(0))).otherwise(0) for c in FLAG_REGRESSORS}
    return rows.select(
        "nom_produit", "ds", F.when(seen, F.col("quantite")).otherwise(0.0).alias("y"),
        *[expr.alias(c) for c, expr in filled.items()],
    )


def active_days(dense: DataFrame) -> DataFrame:
    return dense.groupBy("nom_produit").agg(
        F.count_if(F.col("y") > 0).alias("jours_avec"),
        F.count_if(F.col("y") == 0).alias("jours_sans"),
    )


def last_days(dense: DataFrame, n: int = 30) -> DataFrame:
    """The last ``n`` days of each product with their mean."""
    recent = dense.withColumn("_fin", F.max("ds").over(per_product())).where(_days("_fin", "ds") < n)
    return recent.select("nom_produit", "ds", "y", F.avg("y").over(per_product()).alias("moyenne_recente"))


# --- events -------------------------------------------------------------------


EventWindows = Sequence[tuple[str, int, int]]
NO_WINDOWS: EventWindows = [(label, 0, 0) for label, _ in HOLIDAY_FLAGS]


def _event_rows(rows: DataFrame, keys: Sequence[str], windows: EventWindows = NO_WINDOWS) -> DataFrame:
    reach = {label: (first, last) for label, first, last in windows}
    labels = F.array_compact(F.array(*[
        F.when(F.col(flag) == 1, F.struct(F.lit(label).alias("holiday"), *[F.lit(d).alias(c) for c, d in zip(("lower_window", "upper_window"), reach.get(label, (0, 0)))]))
        for label, flag in HOLIDAY_FLAGS
    ]))
    return rows.select(*keys, F.inline(labels))


def holidays(dense: DataFrame, windows: EventWindows = NO_WINDOWS) -> DataFrame:
    """Event days of each product, one row per label. A day may carry several labels."""
    return _event_rows(dense, ["nom_produit", "ds"], windows)


def event_terms(windows: EventWindows = NO_WINDOWS) -> list[tuple[str, int]]:
    """(label, offset) of each effect that events with these windows have, labels in their fixed order."""
    reach = {label: (first, last) for label, first, last in windows}
    unknown = set(reach) - {label for label, _ in HOLIDAY_FLAGS}
    if unknown or any(first > 0 or last < 0 for first, last in reach.values()):
        raise ValueError(f"windows name unknown events or leave out the day itself: {windows}")
    return [(label, offset) for label, _ in HOLIDAY_FLAGS for offset in range(reach.get(label, (0, 0))[0], reach.get(label, (0, 0))[1] + 1)]


def event_offset(flag: Column, offsets: Sequence[int]) -> Column:
    """Days since the event that a day of a dense series belongs to, negative before it; null beyond the window.

    A day within reach of several events belongs to the nearest, of two equally near ones to the earlier, so runs of event
    days have offsets at their ends only.
    """
    order = per_product().orderBy("ds")
    nearest = sorted(offsets, key=lambda o: (abs(o), -o))
    return F.coalesce(*[F.when((F.lag(flag, o).over(order) if o else flag) == 1, F.lit(o)) for o in nearest])


def holiday_offsets(dense: DataFrame, windows: EventWindows) -> DataFrame:
    """Days of each product that lie in the window of an event, with their offset: one row per day and label."""
    terms = event_terms(windows)
    found = F.array_compact(F.array(*[
        F.when(F.col(f"_{flag}").isNotNull(), F.struct(F.lit(label).alias("holiday"), F.col(f"_{flag}").alias("offset")))
        for label, flag in HOLIDAY_FLAGS
    ]))
    placed = dense.withColumns({f"_{flag}": event_offset(F.col(flag), [o for name, o in terms if name == label]) for label, flag in HOLIDAY_FLAGS})
    return placed.select("nom_produit", "ds", F.inline(found))


def holiday_calendar(mv: DataFrame) -> DataFrame:
    """Event days seen in any movement, for all products alike."""
    flags = [flag for _, flag in HOLIDAY_FLAGS]
    days = mv.where(F.col("date").isNotNull()).groupBy(F.col("date").alias("ds")).agg(*[F.max(f).alias(f) for f in flags])
    return _event_rows(days, ["ds"])


def holiday_counts(events: DataFrame) -> DataFrame:
    keys = [k for k in ("nom_produit", "holiday") if k in events.columns]
    return events.groupBy(*keys).agg(F.count("*").alias("nb_jours"))


def changepoints(dense: DataFrame, dates: Sequence[str]) -> DataFrame:
    """The known change dates that fall inside each product's history."""
    span = dense.groupBy("nom_produit").agg(F.min("ds").alias("debut"), F.max("ds").alias("fin"))
    known = F.array(*[F.lit(d).cast("date") for d in dates])
    return (
        span.withColumn("changepoint", F.explode(known))
        .where((F.col("changepoint") > F.col("debut")) & (F.col("changepoint") <= F.col("fin")))
        .select("nom_produit", "changepoint")
    )


def auto_changepoint(start: Column, head: Column, n: Column, rank: Column) -> Column:
    """Day of the ``rank``-th of ``n`` change dates spread over the first ``head`` days."""
    return F.date_add(start, F.bround(rank * (head - 1) / n).cast("int"))


def auto_changepoints(
    dense: DataFrame, n: int = AUTO_CHANGEPOINTS, share: float = AUTO_CHANGEPOINT_SHARE
) -> DataFrame:
    """Change dates spread evenly over the leading ``share`` of each history.

    A dense series has one row per day, so the k-th row is the first day plus k.
    """
    span = dense.groupBy("nom_produit").agg(F.min("ds").alias("debut"), F.count("ds").alias("nb"))
    lead = F.floor(F.col("nb") * F.lit(share))
    count = F.least(F.lit(n), lead - 1).cast("int")
    return (
        span.withColumns({"_tete": lead, "_nb_cp": count}).where(F.col("_nb_cp") > 0)
        .withColumn("rang", F.explode(F.sequence(F.lit(1), F.col("_nb_cp"))))
        .select("nom_produit", "rang", auto_changepoint(F.col("debut"), F.col("_tete"), F.col("_nb_cp"), F.col("rang")).alias("changepoint"))
    )


# --- splits -------------------------------------------------------------------


def with_split(dense: DataFrame, share: float | None = None, days: int | None = None) -> DataFrame:
    """Adds the boundary ``date_coupure`` and ``apprentissage`` for rows up to it.

    The test part is the last ``days`` days, or the last ``share`` of the history.
    """
    if (share is None) == (days is None):
        raise ValueError("give either share or days")
    last = F.max("ds").over(per_product())
    length = F.lit(days) if days is not None else (F.count("ds").over(per_product()) * F.lit(share)).cast("int")
    return dense.withColumn("date_coupure", F.date_sub(last, length)).withColumn(
        "apprentissage", F.col("ds") <= F.col("date_coupure")
    )


def split_summary(split: DataFrame) -> DataFrame:
    train, test = F.col("apprentissage"), ~F.col("apprentissage")
    return split.groupBy("nom_produit", "date_coupure").agg(
        F.count_if(train).alias("nb_apprentissage"),
        F.count_if(test).alias("nb_test"),
        F.min(F.when(train, F.col("ds"))).alias("debut_apprentissage"),
        F.max(F.when(train, F.col("ds"))).alias("fin_apprentissage"),
        F.min(F.when(test, F.col("ds"))).alias("debut_test"),
        F.max(F.when(test, F.col("ds"))).alias("fin_test"),
        (F.count_if(train) * F.lit(100.0) / F.count("*")).alias("pct_apprentissage"),
    )


def split_80_20(dense: DataFrame) -> DataFrame:
    return split_summary(with_split(dense, share=TEST_SHARE))


def split_365(dense: DataFrame) -> DataFrame:
    return split_summary(with_split(dense, days=TEST_DAYS))


def split_coverage(split: DataFrame) -> DataFrame:
    """Regressor values present on the test days of each product."""
    columns = [name for name, _, _ in MODEL_REGRESSORS]
    return split.where(~F.col("apprentissage")).groupBy("nom_produit").agg(
        F.count("*").alias("nb_test"), *[F.count(c).alias(f"nb_{c}") for c in columns]
    )


# --- future days --------------------------------------------------------------


def future_frame(
    dense: DataFrame, periods: int = FORECAST_DAYS, fill: str = "mean", events: DataFrame | None = None
) -> DataFrame:
    """History plus ``periods`` days whose regressors, if there are any, are filled in.

    Continuous regressors take the product's mean; ``fill="month"`` takes the
    mean of the same month of year for the temperature, where there is one. Flu
    is on from January to March; other flags are unknown and stay off, unless
    ``events(ds, holiday)`` names the days to come.
    """
    last = F.max("ds").over(per_product())
    ends = F.when(F.col("ds") == last, F.date_add("ds", periods)).otherwise(F.col("ds"))
    rows = (
        dense.withColumn("_fin", ends)
        .withColumn("_jour", F.explode(F.sequence("ds", "_fin")))
        .withColumn("futur", F.col("_jour") > F.col("ds"))
        .withColumn("_mois", F.month("_jour"))
    )
    ahead = dict.fromkeys(FLAG_REGRESSORS, F.lit(0)) | {"epidemie_grippe": F.col("_mois").isin(FLU_MONTHS).cast("int")}
    if events is not None:
        named = events.groupBy(F.col("ds").alias("_jour")).agg(*[
            F.max((F.col("holiday") == label).cast("int")).alias(f"_{flag}") for label, flag in HOLIDAY_FLAGS
        ])
        # One row per calendar day.
        rows = rows.join(F.broadcast(named), "_jour", "left")
        ahead |= {flag: F.coalesce(F.col(f"_{flag}"), F.lit(0)) for _, flag in HOLIDAY_FLAGS}
    future = F.col("futur")
    columns: dict[str, Column] = {}
    for c in (c for c in MEAN_REGRESSORS if c in dense.columns):
        known = F.when(~future, F.col(c))
        mean = F.avg(known).over(per_product())
        if fill == "month" and c == "temperature":
            mean = F.coalesce(F.avg(known).over(Window.partitionBy("nom_produit", "_mois")), mean)
        columns[c] = F.coalesce(known, mean)
    for c in (c for c in FLAG_REGRESSORS if c in dense.columns):
        columns[c] = F.when(future, ahead[c]).otherwise(F.col(c))
    return rows.select(
        "nom_produit", F.col("_jour").alias("ds"), F.when(~future, F.col("y")).alias("y"), "futur",
        *[expr.alias(c) for c, expr in columns.items()],
    )


# --- model features -----------------------------------------------------------


def day_number(day: str = "ds") -> Column:
    return _days(F.col(day), F.lit(EPOCH).cast("date"))


def fourier_terms(day: str = "ds", yearly: int = YEARLY_ORDER, weekly: int = WEEKLY_ORDER) -> dict[str, Column]:
    """sin and cos of each yearly and weekly frequency, by day since 1970."""
    terms: dict[str, Column] = {}
    for name, order, period in (("annuel", yearly, YEAR_PERIOD), ("hebdo", weekly, WEEK_PERIOD)):
        for k in range(1, order + 1):
            angle = F.lit(2.0 * k) * F.pi() * day_number(day) / F.lit(period)
            terms[f"{name}_sin{k}"] = F.sin(angle)
            terms[f"{name}_cos{k}"] = F.cos(angle)
    return terms


def fourier_features(days: DataFrame, day: str = "ds") -> DataFrame:
    """Fourier terms per calendar day: they depend on nothing else."""
    return days.select(day).where(F.col(day).isNotNull()).distinct().select(
        day, *[expr.alias(name) for name, expr in fourier_terms(day).items()])


def trend_features(dense: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Days since the product's start, and since each known change date inside its history."""
    start, end = F.min("ds").over(per_product()), F.max("ds").over(per_product())
    columns = []
    for i, d in enumerate(dates, 1):
        date = F.lit(d).cast("date")
        hinge = F.greatest(F.lit(0), _days(F.col("ds"), date))
        columns.append(F.when((date > start) & (date <= end), hinge).otherwise(0).alias(f"rupture_{i}"))
    return dense.select("nom_produit", "ds", _days(F.col("ds"), start).alias("t"), *columns)


def regressor_scales(train: Column) -> dict[str, tuple[Column, Column]]:
    """Centre and scale of each model regressor on its product's training rows."""
    scales = {}
    for name, _, scaled in MODEL_REGRESSORS:
        known = F.when(train, F.col(name).cast("double"))
        spread = F.stddev_samp(known).over(per_product())
        scales[name] = (
            F.avg(known).over(per_product()) if scaled else F.lit(0.0),
            F.when(spread > 0, spread).otherwise(1.0) if scaled else F.lit(1.0),
        )
    return scales


def standardized(train: Column) -> dict[str, Column]:
    """Model regressors, continuous ones centred and scaled by the product's training rows."""
    return {name: (F.col(name) - centre) / scale for name, (centre, scale) in regressor_scales(train).items()}


def standardized_regressors(split: DataFrame) -> DataFrame:
    return split.select(
        "nom_produit", "ds", "apprentissage",
        *[expr.alias(f"{name}_z") for name, expr in standardized(F.col("apprentissage")).items()],
    )


def regressor_choice(mv: DataFrame, choices: dict[str, list[str]]) -> DataFrame:
    """Regressors to use per product, from its type and shelf life.

    Products carry no food family, so the shelf life stands for it: under 3 days
    is ultra-perishable, under 7 days is fresh produce.
    """
    life = F.avg(shelf_life())
    category = (
        F.when(F.col("type_produit") == CLEANING, "entretien")
        .when(F.col("_classe") == "critique", "ultra_perissable")
        .when(F.col("_classe") == "attention", "legumes_fruits")
        .otherwise("stable")
    )
    rules = F.create_map(*[
        x for name, regressors in choices.items() for x in (F.lit(name), F.array(*[F.lit(r) for r in regressors]))
    ])
    return (
        with_keys(mv, ["nom_produit", "type_produit"]).groupBy("nom_produit", "type_produit")
        .agg(perishability(life).alias("_classe"))
        .withColumn("categorie", category)
        .select("nom_produit", "categorie", F.explode(rules[F.col("categorie")]).alias("regresseur"))
    )
