"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code holds the signs of its components. Codes are cut into segments; an index bucket holds the distinct codes
with one value in one segment. In round r every open query probes, in each of the m segments, the buckets whose value
differs in exactly r bits. What it finds is verified over the whole code. A code that no probe up to radius r has met
differs in more than r bits in every segment, so its distance is at least m(r + 1): once the k-th verified distance is
below that, the query is closed. Nothing is capped: rounds go on until every query is closed or radii reach the width.

Wide segments have far more masks of r bits than a plan or a sparse index can use. Where a segment has more masks than
buckets, open queries meet the buckets' values instead and keep those in exactly r bits; beyond ``LISTED`` masks those are a
table. Both joins are dealt into parts of bounded size.

Segments are about log2(n) - 8 bits wide, so buckets keep some 256 codes as the data grow. Equal codes are one entry with
its smallest k + 1 identifiers. Buckets and probes are packed into blocks of bounded size before they meet, so a bucket
with a third of all codes is many pairs of blocks, and distances are computed for a pair of blocks at a time.

Defined results: rows without vector or identifier are neither found nor searched for; missing components have bit 0, NaN
bit 1; a query doesn't find its own identifier; ties go to the smaller identifier; repeated rows count once; with fewer
than k others all are returned; codes are as long as the longest vector; an empty table gives an empty result. Identifiers
are whole numbers: others raise an error before anything runs.
"""

from __future__ import annotations

import functools
import itertools
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import table, whole_numbers
from larder.session import materialize

TOP_K = 10
EVERY = 20
INDEX_BLOCK, QUERY_BLOCK = 4096, 1024
AT_ONCE = 64
FAR = 1 << 20
# The most masks of a segment that are written into the plan, and about how many partners and queries one key of a join holds.
LISTED = 2048
PARTNERS, ASKING = 4096, 65536
# Segments by place: word, shift and width of each.
Places = dict[int, tuple[int, int, int]]


def sign_code(vector: Column, words: int) -> Column:
    """Signs of a vector as ``words`` whole numbers of 64 bits: bit i of word w is set where component 64 w + i is not negative."""

    def word(w: int) -> Column:
        bits = F.transform(F.slice(vector, 64 * w + 1, 64), lambda x, i: F.when(x >= 0, F.expr("shiftleft(1L, 0)")).otherwise(F.lit(0).cast("long")))
        # Horner from the last component: the first ends in the lowest bit.
        return F.aggregate(F.reverse(bits), F.lit(0).cast("long"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b))

    return F.array(*[word(w) for w in range(words)])


def segment_width(codes: int) -> int:
    return min(32, max(8, round(math.log2(max(codes, 2))) - 8))


def _segments(words: int, width: int) -> Places:
    """(word, shift, width) of each segment; none crosses a word."""
    return dict(enumerate((w, at, min(width, 64 - at)) for w in range(words) for at in range(0, 64, width)))


def _value(code: str, segment: tuple[int, int, int]) -> Column:
    word, shift, width = segment
    return F.shiftrightunsigned(F.get(code, F.lit(word)), shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _exploded(df: DataFrame, code: str, segments: Places, radius: int) -> DataFrame:
    """One row per segment and value within exactly ``radius`` bits: columns segment and value are added."""
    parts = []
    for place, segment in segments.items():
        value = _value(code, segment)
        masks = [sum(1 << b for b in bits) for bits in itertools.combinations(range(segment[2]), radius)]
        values = F.array(value) if radius == 0 else F.transform(
            F.split(F.lit(",".join(map(str, masks))), ","), lambda m: value.bitwiseXOR(m.cast("long")))
        parts.append(F.struct(F.lit(place).alias("segment"), values.alias("values")))
    spread = df.withColumn("part", F.explode(F.array(*parts)))
    return spread.select(*df.columns, F.col("part.segment").alias("segment"), F.explode("part.values").alias("value"))


def _beside(queries: DataFrame, n_queries: int, segments: Places, partners: DataFrame, most: int) -> DataFrame:
    """Every query's own value of each segment beside all ``other`` of that segment's partners, at most ``most`` of them.

    Both sides are dealt into parts, so one key of the join holds some ``PARTNERS`` x ``ASKING`` pairs however many there are.
    """
    parts, groups = -(-max(1, most) // PARTNERS), -(-max(1, n_queries) // ASKING)
    own = F.explode(F.array(*[F.struct(F.lit(place).alias("segment"), _value("query", s).alias("own")) for place, s in segments.items()]))
    left = queries.select("*", own.alias("o")).select(*queries.columns, "o.segment", "o.own", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int").alias("group"))
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = partners.withColumn("part", F.pmod(F.xxhash64("other"), F.lit(parts)).cast("int"))
    return left.join(right.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))), ["segment", "part", "group"])


def _probes(queries: DataFrame, n_queries: int, index: DataFrame, buckets: dict[int, int], segments: Places, radius: int) -> DataFrame:
    """The buckets in exactly ``radius`` bits from each query, per segment: columns query, bound, segment, value.

    Where fewer buckets than masks exist, queries meet the buckets' values; else the masks, a table where they are many.
    """
    masks = {place: math.comb(s[2], radius) for place, s in segments.items() if radius <= s[2]}
    met = {place: segments[place] for place, n in masks.items() if n > buckets.get(place, 0)}
    listed = {place: segments[place] for place, n in masks.items() if place not in met and n <= LISTED}
    tabled = {place: segments[place] for place in masks if place not in met and place not in listed}
    spark, columns = queries.sparkSession, [*queries.columns, "segment", "value"]
    found = []
    if listed:
        found.append(_exploded(queries, "query", listed, radius).select(columns))
    if met:
        values = index.where(F.col("segment").isin(list(met))).select("segment", F.col("value").alias("other")).distinct()
        beside = _beside(queries, n_queries, met, values, max(buckets.get(place, 0) for place in met))
        found.append(beside.where(F.bit_count(F.col("own").bitwiseXOR(F.col("other"))) == radius).withColumnRenamed("other", "value").select(columns))
    for width in {s[2] for s in tabled.values()}:
        places = {place: s for place, s in tabled.items() if s[2] == width}
        every = spark.range(1 << width).where(F.bit_count("id") == radius)
        every = every.select(F.explode(F.array(*map(F.lit, places))).alias("segment"), F.col("id").alias("other"))
        beside = _beside(queries, n_queries, places, every, math.comb(width, radius))
        found.append(beside.withColumn("value", F.col("own").bitwiseXOR(F.col("other"))).select(columns))
    return functools.reduce(DataFrame.unionByName, found)


def _packed(rows: DataFrame, line: Column, block: int, name: str) -> DataFrame:
    """Lists of ``line`` per (segment, value), each of about ``block`` entries at most."""
    sizes = rows.groupBy("segment", "value").agg(F.count("*").alias("n")).where(F.col("n") > block)
    large = rows.join(sizes, ["segment", "value"], "left")
    salt = F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64(line), F.ceil(2 * F.col("n") / block)))
    return large.withColumn("salt", salt).groupBy("segment", "value", "salt").agg(F.collect_list(line).alias(name)).drop("salt")


FOUND = "query array<long>, distance int, first_id long, code array<long>"


def _verified(pairs: DataFrame, words: int, most: int) -> DataFrame:
    """Distances between the queries and codes of each pair of blocks; per query and block the best ``most`` within its bound."""

    def arrays(lists: pa.ListArray, at: int, fields: tuple[str, ...]):
        block = lists.slice(at, 1).flatten()
        return [block.field(f).flatten().to_numpy().reshape(len(block), words) if pa.types.is_list(block.field(f).type) else block.field(f).to_numpy() for f in fields]

    def run(batches):
        for batch in batches:
            out = ([], [], [], [])
            for at in range(batch.num_rows):
                codes, ids = arrays(batch.column("codes"), at, ("code", "first_id"))
                queries, bounds = arrays(batch.column("queries"), at, ("query", "bound"))
                order = np.argsort(ids, kind="stable")
                codes, ids = codes[order], ids[order]
                for start in range(0, len(queries), AT_ONCE):
                    some = queries[start : start + AT_ONCE]
                    far = np.bitwise_count((some[:, None, :] ^ codes[None, :, :]).view(np.uint64)).sum(axis=2, dtype=np.int64)
                    # Distance first, then the place by identifier: one number to order by.
                    key = far * (INDEX_BLOCK * 64) + np.arange(len(codes))
                    if len(codes) > most:
                        best = np.argpartition(key, most - 1, axis=1)[:, :most]
                    else:
                        best = np.broadcast_to(np.arange(len(codes)), far.shape)
                    near = np.take_along_axis(far, best, axis=1)
                    q, c = np.nonzero(near <= bounds[start : start + AT_ONCE, None])
                    hit = best[q, c]
                    for column, values in zip(out, (some[q], near[q, c], ids[hit], codes[hit])):
                        column.append(values)

            def words_of(parts):
                flat = np.concatenate(parts) if parts else np.empty((0, words), np.int64)
                return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * words, pa.int32()), pa.array(flat.ravel(), pa.int64()))

            yield pa.RecordBatch.from_arrays([
                words_of(out[0]), pa.array(np.concatenate(out[1] or [np.empty(0)]), pa.int32()),
                pa.array(np.concatenate(out[2] or [np.empty(0)]), pa.int64()), words_of(out[3])], ["query", "distance", "first_id", "code"])

    return pairs.select("queries", "codes").mapInArrow(run, FOUND)


def _best(found: DataFrame, most: int) -> DataFrame:
    first = Window.partitionBy("query").orderBy("distance", "first_id")
    return found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= most).drop("place")


def search(
    vectors: DataFrame, queries: DataFrame, k: int = TOP_K, id_col: str = "vec_id", vector_col: str = "embedding", bits: int | None = None, width: int | None = None,
) -> DataFrame:
    """The k nearest other rows of ``vectors`` by sign code, per row of ``queries``: id, neighbour_id, distance, rank.

    Codes are as long as the longest vector, or have the given number of ``bits``, which no vector may exceed.
    """

    whole_numbers(vectors, id_col)
    whole_numbers(queries, id_col)

    def usable_of(df: DataFrame) -> DataFrame:
        return df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())

    longest = max(usable_of(df).agg(F.max(F.size(vector_col))).first()[0] or 0 for df in (vectors, queries))
    if bits is not None and longest > bits:
        raise ValueError(f"a vector has {longest} components, codes have {bits} bits")
    words, most = max(1, -(-(bits or longest) // 64)), k + 1

    def coded(df: DataFrame) -> DataFrame:
        usable = usable_of(df)
        return usable.select(F.col(id_col).cast("long").alias("id"), sign_code(F.col(vector_col), words).alias("code")).distinct()

    # At most k + 1 identifiers of a code are kept, task by task before they meet.
    by_id = Window.partitionBy("code").orderBy("id")
    few = coded(vectors).withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= most)
    codes = materialize(few.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    asked = materialize(coded(queries), "queries")
    wanted = asked.select(F.col("code").alias("query")).distinct()

    n_codes = codes.count()
    segments = _segments(words, width or segment_width(n_codes))
    entries = codes.select("code", F.element_at("ids", 1).alias("first_id"))
    index = materialize(_packed(_exploded(entries, "code", segments, 0), F.struct("code", "first_id"), INDEX_BLOCK, "codes"), "buckets")

    best = None
    # One line per segment.
    buckets = {r["segment"]: r["n"] for r in index.groupBy("segment").agg(F.count_distinct("value").alias("n")).collect()}
    still = materialize(wanted.withColumn("bound", F.lit(FAR)), "open")
    n_open = still.count()
    for radius in range(max(s[2] for s in segments.values()) + 1):
        probes = _probes(still, n_open, index, buckets, segments, radius)
        probes = _packed(probes, F.struct("query", "bound"), QUERY_BLOCK, "queries")
        found = _verified(probes.join(index, ["segment", "value"]), words, most)
        found = found.groupBy("query", "code").agg(F.min("distance").alias("distance"), F.min("first_id").alias("first_id"))
        if best is not None:
            found = best.unionByName(found).distinct()
        best = materialize(_best(found, most), "best")
        kth = best.groupBy("query").agg(F.count("*").alias("n"), F.max("distance").alias("last"))
        # With all codes met, nothing is unseen.
        bound = F.when(F.col("n") == n_codes, -1).when(F.col("n") == most, F.col("last")).otherwise(FAR)
        # Whatever is still unseen is at least this far away.
        unseen = len(segments) * (radius + 1)
        still = still.select("query").join(kth, "query", "left").select("query", F.coalesce(bound, F.lit(FAR)).alias("bound")).where(F.col("bound") >= unseen)
        still = materialize(still, "open")
        n_open = still.count()
        if not n_open:
            break
    near = asked.join(best.withColumnRenamed("code", "near"), asked["code"] == best["query"]).join(codes.select(F.col("code").alias("near"), "ids"), "near")
    lines = near.select("id", "distance", F.explode("ids").alias("neighbour_id")).where(F.col("neighbour_id") != F.col("id"))
    ranked = lines.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour_id")))
    return ranked.where(F.col("rank") <= k).select(F.col("id").alias(id_col), "neighbour_id", "distance", "rank")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Queries: every row whose vec_id is divisible by 20, against all rows."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


SQL = f"""
WITH c AS (SELECT vec_id, [x >= 0 FOR x IN embedding] AS bits FROM embeddings),
d AS (
  SELECT q.vec_id, c.vec_id AS neighbour_id,
         list_sum([CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END FOR z IN list_zip(q.bits, c.bits)])::INTEGER AS distance
  FROM c AS q, c WHERE q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour_id)::INTEGER AS rank FROM d)
SELECT vec_id, neighbour_id, distance, rank FROM r WHERE rank <= {TOP_K}
"""

cloudpickle.register_pickle_by_value(sys.modules[__name__])
