"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.fixed_values import (
    COLD_MONTHS,
    CRITICAL_LIFE_DAYS,
    FIRST_WEEKEND_DAY,
    PERISHABLE_LIFE_DAYS,
)


def total(col: str | Column) -> Column:
    """Sum that is 0.0 when every value is null."""
    return F.coalesce(F.sum(col), F.lit(0.0))


def half_even(col: Column, digits: int = 2) -> Column:
    return F.bround(col, digits)


def percent(part: Column, whole: Column) -> Column:
    """part / whole as a percentage, null for an empty whole."""
    return F.try_divide(part * F.lit(100.0), whole)


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose grouping keys are all present: groups never form on a null key."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def last_word(col: str) -> Column:
    return F.substring_index(F.col(col), " ", -1)


def slug(col: str | Column, lower: bool = True) -> Column:
    """Product name as used in file and partition names."""
    col = F.col(col) if isinstance(col, str) else col
    joined = F.replace(col, F.lit(" "), F.lit("_"))
    return F.lower(joined) if lower else joined


def add_calendar(df: DataFrame, day: str = "date") -> DataFrame:
    """Year, month, day of month, weekday (Monday = 0), weekday name and ISO week."""
    return df.withColumns({
        "annee": F.year(day),
        "mois": F.month(day),
        "jour_mois": F.dayofmonth(day),
        "jour_semaine": F.weekday(day),
        "nom_jour": F.date_format(day, "EEEE"),
        "semaine": F.weekofyear(day),
    })


def shelf_life(expiry: str = "date_expiration", day: str = "date") -> Column:
    return F.datediff(expiry, day)


def add_shelf_life(df: DataFrame) -> DataFrame:
    return df.withColumn("duree_vie_jours", shelf_life())


def perishability(life: Column) -> Column:
    return (
        F.when(life < CRITICAL_LIFE_DAYS, "critique")
        .when(life < PERISHABLE_LIFE_DAYS, "attention")
        .when(life.isNotNull(), "stable")
    )


def is_cold_season(month: Column) -> Column:
    return month.isin(COLD_MONTHS)


def is_weekend(weekday: Column) -> Column:
    return weekday >= FIRST_WEEKEND_DAY


def unpivot_aggregates(df: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """One aggregation pass over ``df``, returned as one output row per dict in ``rows``."""
    lines = F.array(*[
        F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows
    ])
    return df.agg(lines.alias("lignes")).select(F.inline("lignes"))


def drift_variance(rate: Column, size: Column, ahead: Column) -> Column:
    """Variance that future breaks give a trend ``ahead`` days after the last one known.

    Breaks come ``rate`` times a day and change the daily slope by a Laplace distributed step of mean size ``size``, whose
    variance is twice its square; one that comes s days ahead of the day asked for moves the trend there by s steps. So the
    variance is rate * 2 size^2 * (the sum of s^2, which is ahead^3 / 3).
    """
    h = F.greatest(ahead, F.lit(0)).cast("double")
    return rate * 2 * size * size * h * h * h / 3
