"""Running totals that never put a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.columns import with_keys

def running_total(
    df: DataFrame,
    group: Sequence[str],
    day: str,
    block: Column,
    order: Sequence[Column | str],
    value: Column | str,
    out: str,
) -> DataFrame:
    """Running sum of ``value`` per ``group``, rows ordered by day, then ``order``.

    Only daily sums are ordered over a whole group, block sums within a day, and
    rows within one ``block`` of a day: a day with very many rows is many blocks.
    ``block`` is any whole number that never falls along ``order``. Rows without a
    group or day get null. ``value`` and ``order`` may be expressions, worked out
    after the shuffle.
    """
    per_day = [*group, day]
    per_block = [*per_day, "_bloc"]
    before = (Window.unboundedPreceding, -1)

    def total_before(value, window):
        return F.coalesce(F.sum(value).over(window.rowsBetween(*before)), F.lit(0.0))

    marked = df.withColumn("_bloc", block.cast("long"))
    blocks = with_keys(marked, per_day).groupBy(*per_block).agg(F.sum(value).alias("_somme"), F.count("*").alias("_nb"))
    days = blocks.groupBy(*per_day).agg(F.sum("_somme").alias("_jour"), F.sum("_nb").alias("_nb"))
    # Both uses below need both columns, so they share one aggregation of the table.
    day_offsets = days.where(F.col("_nb") > 0).select(
        *per_day, total_before("_jour", Window.partitionBy(*group).orderBy(day)).alias("_avant_jour"))
    block_offsets = blocks.where(F.col("_nb") > 0).select(
        *per_block, total_before("_somme", Window.partitionBy(*per_day).orderBy("_bloc")).alias("_avant_bloc"))
    offsets = block_offsets.join(day_offsets, per_day).select(
        *per_block, (F.col("_avant_jour") + F.col("_avant_bloc")).alias("_avant"))
    inside = Window.partitionBy(*per_block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        marked.join(offsets, per_block, "left")
        .withColumn(out, F.sum(value).over(inside) + F.col("_avant"))
        .drop("_avant", "_bloc")
    )
