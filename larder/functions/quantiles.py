"""Exact interpolated quantiles by counting: no column is ever sorted and no task holds more than a few counts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 1024


@dataclass
class _Range:
    column: str
    low: float
    high: float
    below: int
    ranks: list[int]


def _counted(df: DataFrame, ranges: list[_Range]) -> DataFrame:
    """Count, smallest and largest value of each bin that holds any. A task counts its own rows and hands on bins only."""
    columns = list(dict.fromkeys(r.column for r in ranges))
    # In halves where the width of the range would overflow.
    bounds = [(i, columns.index(r.column), r.low, r.high, 1.0 if math.isfinite(r.high - r.low) else 0.5) for i, r in enumerate(ranges)]
    bins = BINS

    def count(batches):
        """A task's bins that are not empty. Defined here, so that it travels with the job."""
        import numpy as np
        import pyarrow as pa

        nb = np.zeros((len(bounds), bins), "int64")
        bas, haut = np.full(nb.shape, np.inf), np.full(nb.shape, -np.inf)
        for batch in batches:
            values = [column.drop_null().to_numpy(zero_copy_only=False) for column in batch.columns]
            for i, at, low, high, part in bounds:
                inside = values[at][(values[at] >= low) & (values[at] <= high)]
                if np.isinf([low, high]).any():
                    # Infinite values first get bins of their own.
                    case = np.where(np.isinf(inside), np.sign(inside), 0).astype("int64") + 1
                else:
                    share = (inside * part - low * part) / (high * part - low * part)
                    case = np.minimum((share * bins).astype("int64"), bins - 1)
                nb[i] += np.bincount(case, minlength=bins)
                np.minimum.at(bas[i], case, inside)
                np.maximum.at(haut[i], case, inside)
        plage, case = (found.astype("int32") for found in nb.nonzero())
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (plage, case, nb[plage, case], bas[plage, case], haut[plage, case])], ["plage", "case", "nb", "bas", "haut"])

    return (
        df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
        .mapInArrow(count, "plage int, case int, nb long, bas double, haut double")
        .groupBy("plage", "case").agg(F.sum("nb").alias("nb"), F.min("bas").alias("bas"), F.max("haut").alias("haut"))
    )


def _counts(df: DataFrame, ranges: list[_Range]) -> dict[int, list[tuple[int, float, float]]]:
    """Per range its bins in order: count, smallest and largest value. One pass; ranges of a column don't overlap."""
    # At most BINS lines per range, and a column has at most two ranges per quantile.
    out: dict[int, list] = {i: [] for i in range(len(ranges))}
    for row in sorted(_counted(df, ranges).collect(), key=lambda r: (r["plage"], r["case"])):
        out[row["plage"]].append((row["nb"], row["bas"], row["haut"]))
    return out


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], known: dict[str, tuple[int, float, float]]
) -> dict[str, list[float | None]]:
    """Quantiles of each column. ``known``: how many values it has, the smallest and the largest.

    The bin that holds a wanted rank is cut into bins again until it holds one value. Each pass makes bins a thousand times
    finer, so a handful of passes ends the search for any doubles, at any size.
    """
    found: dict[tuple[str, int], float] = {}
    ranges = []
    for c in columns:
        n, low, high = known[c]
        if n:
            ranks = sorted({f(p * (n - 1)) for p in probs for f in (math.floor, math.ceil)})
            ranges.append(_Range(c, low, high, 0, ranks))
    while ranges:
        for r in (r for r in ranges if r.low == r.high):
            found |= {(r.column, rank): r.low for rank in r.ranks}
        ranges = [r for r in ranges if r.low < r.high]
        if not ranges:
            break
        counts, finer = _counts(df, ranges), []
        for i, r in enumerate(ranges):
            below = r.below
            for n, low, high in counts[i]:
                inside = [rank for rank in r.ranks if below <= rank < below + n]
                if inside:
                    finer.append(_Range(r.column, low, high, below, inside))
                below += n
        ranges = finer

    def quantile(c: str, p: float) -> float | None:
        n = known[c][0]
        if not n:
            return None
        place = p * (n - 1)
        low, high = found[c, math.floor(place)], found[c, math.ceil(place)]
        return low + (high - low) * (place - math.floor(place))

    return {c: [quantile(c, p) for p in probs] for c in columns}
