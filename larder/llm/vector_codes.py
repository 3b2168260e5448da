"""Vector codes by product quantisation in exact integers.

Components become integers, floor(``SCALE`` * x); a vector is cut into equal consecutive parts, and each part is replaced by
the place of its nearest entry in that part's codebook. Codebooks start as the parts of the smallest identifiers' vectors;
each round assigns every part (squared Euclidean distance, the first of equally near entries) and replaces each entry by
floor(sum / count) of its parts, unused entries staying.

All products are matrix products in float64 that lose nothing: integers are split into limbs of so many bits that a sum of
products stays below 2^53, each pair of limbs is one product, and the results are put together in int64. The distance is
x.x - 2 x.c + c.c; its first argmin is the code. Sums per entry are products with the 0/1 matrix of assignments, in limbs as well.

What leaves a task in a round is one line per entry and component, and Spark adds these up, so that the driver gets as many
numbers as the codebooks hold. The data are read once a round; nothing is kept in between.

Defined results: vectors that are null or hold null, NaN or infinite components are left out; the others must have one length, a
multiple of the number of parts, and components so small (``largest``) that distances fit 64 bits: else the job stops and says so. With fewer vectors than entries the codebooks are that short. Rows without identifier are coded like others
and come last when codebooks are started; rows that repeat an identifier are ordered by their vectors. Null labels are one
group. An empty table gives an empty result. Other columns are passed on.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import packed, table, unpacked
from larder.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# Integers of a block of rows, which bounds the memory of a product.
AT_ONCE = 1 << 20


def largest(size: int) -> int:
    """Integers below this have squared distances below 2^62 over parts of ``size`` components."""
    return math.isqrt(2**62 // max(1, size)) // 2


def integers(flat: np.ndarray, size: int, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as int64, of components of parts of ``size``."""
    scaled = np.floor(flat.astype(np.float64) * scale)
    if len(scaled) and np.abs(scaled).max() >= largest(size):
        raise ValueError(f"a component times {scale} is {largest(size)} or more: distances would not fit 64 bits")
    return scaled.astype(np.int64)


def limb_bits(terms: int) -> int:
    """Bits of a limb, so that a sum of ``terms`` products of two limbs is below 2^53."""
    return (53 - max(1, terms - 1).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """x = sum of limb[i] * 2^(bits * i), lower limbs from 0 to 2^bits - 1, the last one signed and below 2^bits in size."""
    out = []
    while len(x) and (x.min() < -(1 << bits) or x.max() >= 1 << bits):
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def exact_product(a: np.ndarray, b: np.ndarray, bits: int | None = None) -> np.ndarray:
    """a @ b of int64 matrices, exact while the result fits 64 bits."""
    bits = bits or limb_bits(a.shape[1])
    total = np.zeros((a.shape[0], b.shape[1]), np.int64)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(limbs(b, bits)):
            total += (x @ y).astype(np.int64) << np.int64(bits * (i + j))
    return total


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest entry of each row, the first of equal ones, and its squared distance."""
    apart = (entries * entries).sum(axis=1) - 2 * exact_product(x, entries.T.copy())
    place = apart.argmin(axis=1)
    return place, (x * x).sum(axis=1) + apart[np.arange(len(x)), place]


def _rows(vectors: pa.Array, parts: int, size: int, scale: int) -> Iterator[np.ndarray]:
    """Blocks of integer rows of a column of vectors."""
    width = parts * size
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(vectors) * width:
        raise ValueError(f"vectors must all have {width} components")
    step = max(1, AT_ONCE // max(1, width))
    for at in range(0, len(vectors), step):
        yield integers(flat[at * width : (at + step) * width], size, scale).reshape(-1, width)


def usable(vector_col: str) -> Column:
    """Whether a vector is there with finite components only."""
    vector = F.col(f"`{vector_col}`")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def start_codebooks(kept: DataFrame, id_col: str, vector_col: str, parts: int, entries: int, scale: int) -> np.ndarray | None:
    """Codebooks (part, entry, place) of the smallest identifiers' vectors; none where there is no vector."""
    first = kept.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v")).orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    if not first:
        return None
    widths = {len(r["v"]) for r in first}
    if len(widths) > 1 or min(widths) % parts or not min(widths):
        raise ValueError(f"vectors must have one length, a multiple of {parts}; found {sorted(widths)}")
    rows = integers(np.array([r["v"] for r in first], np.float64), min(widths) // parts, scale)
    return rows.reshape(len(first), parts, -1).transpose(1, 0, 2).copy()


def _tally(kept: DataFrame, vector_col: str, books: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum and count of the parts assigned to each entry, added up by Spark."""
    parts, entries, size = books.shape

    def run(batches):
        sums, counts = np.zeros((parts, entries, size), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for rows in _rows(batch.column(0), parts, size, scale):
                for p in range(parts):
                    x = rows[:, p * size : (p + 1) * size]
                    place, _ = nearest(x, books[p])
                    chosen = np.zeros((entries, len(x)), np.int64)
                    chosen[place, np.arange(len(x))] = 1
                    sums[p] += exact_product(chosen, x)
                    counts[p] += chosen.sum(axis=1)
        used = np.argwhere(counts > 0)
        slots = [int(p) * entries + int(e) for p, e in used]
        yield pa.RecordBatch.from_pydict({
            "slot": pa.array(np.repeat(np.array(slots, np.int32), size + 1), pa.int32()),
            "place": pa.array(np.tile(np.arange(-1, size, dtype=np.int32), len(slots)), pa.int32()),
            "total": pa.array(np.concatenate([np.append(counts[p, e], sums[p, e]) for p, e in used]) if slots else [], pa.int64()),
        })

    lines = kept.select(F.col(f"`{vector_col}`")).mapInArrow(run, "slot int, place int, total long")
    added = lines.groupBy("slot", "place").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))
    # Objects, so that sums over very many rows may pass 64 bits before they are divided.
    sums, counts = np.zeros((parts, entries, size), object), np.zeros((parts, entries), object)
    for r in added.collect():
        at = divmod(r["slot"], entries)
        if r["place"] < 0:
            counts[at] = int(r["total"])
        else:
            sums[(*at, r["place"])] = int(r["total"])
    return sums, counts


def fit(kept: DataFrame, id_col: str, vector_col: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray | None:
    """Codebooks (part, entry, place) after all rounds."""
    books = start_codebooks(kept, id_col, vector_col, parts, entries, scale)
    for _ in range(rounds if books is not None else 0):
        sums, counts = _tally(kept, vector_col, books, scale)
        for p, e in np.argwhere(counts > 0):
            books[p, e] = np.array([s // counts[p, e] for s in sums[p, e]], np.int64)
    return books


def coded(vector: Column, books: np.ndarray, scale: int, spark: SparkSession) -> Column:
    """Struct of a column of usable vectors: codes by part, and the squared distance of each part."""
    parts, entries, size = books.shape
    sent = spark.sparkContext.broadcast(books)

    @F.arrow_udf("codes array<int>, errors array<long>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            found = [[nearest(rows[:, p * size : (p + 1) * size], sent.value[p]) for p in range(parts)] for rows in _rows(vectors, parts, size, scale)]
            codes = [np.stack([place for place, _ in block], axis=1) for block in found]
            errors = [np.stack([error for _, error in block], axis=1) for block in found]
            ends = pa.array(np.arange(0, (len(vectors) + 1) * parts, parts, dtype=np.int32))
            flat = [np.concatenate(x).ravel() if x else np.zeros(0, np.int64) for x in (codes, errors)]
            yield pa.StructArray.from_arrays([
                pa.ListArray.from_arrays(ends, pa.array(flat[0].astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(flat[1]))], ["codes", "errors"])

    return run(vector)


def codebooks_text(books: np.ndarray | None) -> str:
    return "" if books is None else ",".join(map(str, books.ravel().tolist()))


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray | None]:
    """The usable rows as struct ``row`` with ``codes`` and ``errors`` by part, and the codebooks."""
    kept = vectors.where(usable(vector_col))
    books = fit(kept, id_col, vector_col, parts, entries, rounds, scale)
    rows = packed(kept)
    if books is None:
        empty = rows.withColumns({"codes": F.lit(None).cast("array<int>"), "errors": F.lit(None).cast("array<long>")})
        return empty, None
    found = rows.select("row", coded(F.col("row").getField(vector_col), books, scale, vectors.sparkSession).alias("found"))
    return found.select("row", "found.codes", "found.errors"), books


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Per usable vector: vec_id, code, error, label_error, codebooks_sha256."""
    rows, books = compress(table(spark, folder, "embeddings"))
    found = materialize(rows.select(
        F.col("row.vec_id").alias("vec_id"), F.col("row.label").alias("label"),
        F.concat_ws("", F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))).alias("code"),
        F.aggregate("errors", F.lit(0).cast("long"), lambda total, x: total + x).alias("error")), "vector_codes")
    # One line per label; where one label has most rows, the larger side of the join is split by AQE or the lines are sent to it.
    labels = found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    joined = found.join(labels, found["label"].eqNullSafe(labels["of_label"]), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(codebooks_text(books).encode()).hexdigest()).alias("codebooks_sha256"))


def _sql() -> str:
    steps = [
        """rows AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """wide AS MATERIALIZED (SELECT r, k, CAST(floor(4096 * CAST(embedding[k + 1] AS DOUBLE)) AS BIGINT) AS x, len(embedding) // 8 AS d
  FROM rows, range(0, len(embedding)) AS g(k))""",
        "cut AS MATERIALIZED (SELECT r, k // d AS p, k % d AS j, x FROM wide)",
        "book0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, x AS c FROM cut WHERE r <= 16)",
    ]
    for n in range(7):
        steps.append(f"""near{n} AS MATERIALIZED (SELECT r, p, arg_min(e, (apart, e)) AS e, min(apart) AS apart
  FROM (SELECT r, cut.p, e, sum((x - c) * (x - c)) AS apart FROM cut JOIN book{n} USING (p, j) GROUP BY r, cut.p, e) GROUP BY r, p)""")
        if n < 6:
            steps.append(f"""book{n + 1} AS MATERIALIZED (SELECT p, e, j, coalesce((s - ((s % n) + n) % n) // n, c) AS c
  FROM book{n} LEFT JOIN (SELECT p, e, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM near{n} JOIN cut USING (r, p) GROUP BY ALL) USING (p, e, j))""")
    return f"""WITH {", ".join(steps)},
codes AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(apart) AS BIGINT) AS error FROM near6 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) FROM book6) AS codebooks_sha256
FROM rows JOIN codes USING (r)"""


SQL = _sql()

cloudpickle.register_pickle_by_value(sys.modules[__name__])
