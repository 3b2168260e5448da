"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The most bytes of rows that Spark sends to Python at once, to the row: its own limits of 10,000 rows and 64 MB let whole files of
# texts meet in one batch, and each task holds that batch as vectors in the JVM, as Arrow data and as Python strings and results.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Limits the session's Arrow batches to ``BATCH_BYTES``, unless the session sets a limit of its own.

    It stays set, as plans that are returned run later. Results do not depend on it.
    """
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_numbers(df: DataFrame, id_col: str) -> None:
    """Refuses identifiers that are no whole numbers, before anything runs."""
    kind = df.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise ValueError(f"{id_col} must hold whole numbers, not {kind.simpleString()}: number other identifiers first")


def map_batches(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], Any]], schema: str) -> DataFrame:
    """``mapInArrow`` with state: ``start`` runs once per task and returns the function of one batch.

    That function returns a dict of columns (lists or arrays), which is checked against ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema), prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            if batch.num_rows:
                columns = step(batch)
                arrays = [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def strings(column: pa.Array) -> list[str]:
    """A column of strings with null as empty. Bytes that are no UTF-8 become replacement marks."""
    try:
        return [x or "" for x in column.to_pylist()]
    except UnicodeDecodeError:
        raw = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
        return [(x or b"").decode("utf-8", "replace") for x in raw.to_pylist()]


def text_udf(start: Callable[[], Callable[[list[str]], Any]], returns: str):
    """Arrow UDF of one text column. ``start`` runs once per task and returns the function of a batch of texts."""
    small_batches(SparkSession.active())

    @F.arrow_udf(returns)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        step = start()
        for batch in batches:
            yield step(strings(batch))

    return run


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the identifier written as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """The given columns beside the whole row as struct ``row``: added columns can't clash with the row's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[F.col(f"`{n}`").alias(n) for n in names])


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


cloudpickle.register_pickle_by_value(sys.modules[__name__])
