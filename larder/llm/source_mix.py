"""Mixing sources to target weights by Poisson replication. DataFrame operations only.

A document of source s is repeated k times, k drawn from a Poisson distribution whose mean is the repetition rate that
brings s to its share of the output: rate = weight share * output bytes / bytes of s. The draw inverts the
distribution at a number in [0, 1) hashed from seed and identifier, so a repeated task draws the same. Copies are then
dealt over the whole output in the order of another hash.

Defined results: sources that ``weights`` does not name get the weight ``other`` each; null is a source of its own; a
source with only empty texts has rate 1, one of weight 0 vanishes; documents without identifier are drawn by their
text; rows that repeat an identifier get the same count each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import packed, table
from larder.session import materialize

WEIGHTS = {"src0": 2.0, "src1": 3.0, "src2": 0.5}
OTHER = 1.0
SEED = 17
# Above this rate the distribution is built as rows.
HIGH_RATE = 1000.0


def hashed(*parts: Column) -> Column:
    """A whole number below 2^52 from the MD5 of the parts: exact as a double in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def poisson_cdf(rate: Column) -> Column:
    """P(k <= 0), P(k <= 1), ... until the rest is far below the hash's resolution. Terms are kept as logarithms."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 30).cast("int")
    zero = F.struct((-rate).alias("log"), F.exp(-rate).alias("total"), F.array(F.exp(-rate)).alias("cdf"))

    def step(state: Column, k: Column) -> Column:
        log = state["log"] + F.ln(rate) - F.ln(k.cast("double"))
        total = state["total"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("total"), F.concat(state["cdf"], F.array(total)).alias("cdf"))

    cdf = F.aggregate(F.sequence(F.lit(1), last), zero, step, lambda state: state["cdf"])
    return F.when(rate > 0, cdf).otherwise(F.array(F.lit(1.0)))


def high_cdf(rates: DataFrame) -> DataFrame:
    """(mix_source, rate, least, cdf) of sources with high rates: cdf begins at ``least`` copies.

    Counts farther than 10 standard deviations from the mean are below the hash's resolution. The logarithm of a term is
    written with distances from the mean, by Stirling's series, as its parts are much larger than itself. One row per
    count and a running sum per source: linear in the width.
    """
    rate, k = F.col("rate"), F.col("k").cast("double")
    span = 10 * F.sqrt(rate) + 30
    rows = rates.withColumn("least", F.floor(rate - span).cast("long")).withColumn("k", F.explode(F.sequence("least", F.ceil(rate + span).cast("long"))))
    log = (k - rate) - k * F.log1p((k - rate) / rate) - F.ln(F.lit(2 * math.pi) * k) / 2 - 1 / (12 * k) + 1 / (360 * k * k * k)
    summed = rows.withColumn("total", F.sum(F.exp(log)).over(Window.partitionBy("mix_source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    # Sums never fall, so their order is that of the counts.
    return summed.groupBy("mix_source", "rate", "least").agg(F.sort_array(F.collect_list("total")).alias("cdf"))


def source_rates(
    docs: DataFrame, weights: Mapping[str, float], other: float = OTHER, total_bytes: int | None = None,
    source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """One row per source: its repetition rate and the distribution of counts (from ``least`` on) at that rate. Written to the shared folder."""
    sizes = docs.groupBy(F.col(f"`{source_col}`").alias("mix_source")).agg(
        F.sum(F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long")).alias("bytes"))
    weight = F.lit(float(other))
    for name, value in weights.items():
        weight = F.when(F.col("mix_source") == name, F.lit(float(value))).otherwise(weight)
    sizes = materialize(sizes.withColumn("weight", weight), "mix_sources")
    # Two numbers reach the driver.
    sums = sizes.agg(F.sum("weight").alias("weight"), F.sum("bytes").alias("bytes")).first()
    wanted = (sums["bytes"] or 0) if total_bytes is None else total_bytes
    rate = F.when(F.col("bytes") == 0, F.when(F.col("weight") > 0, 1.0).otherwise(0.0)).otherwise(
        F.col("weight") * F.lit(wanted) / (F.lit(sums["weight"] or 0.0) * F.col("bytes")))
    rates = sizes.select("mix_source", rate.alias("rate"))
    low = rates.where(F.col("rate") <= HIGH_RATE).select("mix_source", "rate", F.lit(0).cast("long").alias("least"), poisson_cdf(F.least("rate", F.lit(HIGH_RATE))).alias("cdf"))
    return materialize(low.unionByName(high_cdf(rates.where(F.col("rate") > HIGH_RATE))), "mix_rates")


def replicate(
    docs: DataFrame, weights: Mapping[str, float], other: float = OTHER, seed: int = SEED, total_bytes: int | None = None,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """Struct ``row`` of each document once per copy, with copy, n_copies and shuffle_key, in the order of that key."""
    rates = source_rates(docs, weights, other, total_bytes, source_col, text_col)
    name = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    # `rates` is a written table: Catalyst knows its size, broadcasts it while small and splits hot sources otherwise.
    drawn = packed(docs, id_col, text_col, source_col).withColumn("mix_source", F.col(source_col)).withColumn("mix_name", name)
    drawn = drawn.select("row", "mix_name", F.col("mix_source").alias("mix_of")).join(rates, F.col("mix_of").eqNullSafe(F.col("mix_source")))
    place = hashed(F.lit(str(seed)), F.col("mix_name")) / F.lit(float(2**52))
    counted = drawn.withColumn("n_copies", (F.col("least") + F.size(F.filter("cdf", lambda c: c <= place))).cast("int"))
    copies = counted.where("n_copies > 0").select(
        "row", "mix_name", "n_copies", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy"))
    keyed = copies.withColumn("shuffle_key", hashed(F.lit(f"{seed}-order"), F.col("mix_name"), F.col("copy").cast("string")))
    return keyed.drop("mix_name").orderBy("shuffle_key", "copy")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Per copy: doc_id, source, copy, n_copies and the key of its place."""
    mixed = replicate(table(spark, folder, "documents"), WEIGHTS)
    return mixed.select("row.doc_id", "row.source", "copy", "n_copies", "shuffle_key")


_WEIGHT_SQL = "CASE source " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in WEIGHTS.items()) + f" ELSE {OTHER}::DOUBLE END"
SQL = f"""
WITH RECURSIVE sizes AS (
  SELECT source, sum(coalesce(strlen(text), 0))::BIGINT AS bytes, {_WEIGHT_SQL} AS weight FROM documents GROUP BY source
), rates AS (
  SELECT source, CASE WHEN bytes = 0 THEN 1.0 ELSE weight * (SELECT sum(bytes) FROM sizes)::BIGINT / ((SELECT sum(weight) FROM sizes) * bytes) END AS rate FROM sizes
), terms AS (
  SELECT source, rate, 0 AS k, -rate AS log, exp(-rate) AS cdf FROM rates
  UNION ALL
  SELECT source, rate, k + 1, log + ln(rate) - ln(k + 1.0::DOUBLE), cdf + exp(log + ln(rate) - ln(k + 1.0::DOUBLE)) FROM terms
  WHERE k < ceil(rate + 10 * sqrt(rate) + 30)
), drawn AS (
  SELECT doc_id, source, ('0x' || substr(md5('{SEED}:' || doc_id), 1, 13))::BIGINT / {2**52}.0::DOUBLE AS place FROM documents
), counted AS (
  SELECT doc_id, drawn.source, count(*)::INTEGER AS n_copies
  FROM drawn JOIN terms ON drawn.source IS NOT DISTINCT FROM terms.source AND cdf <= place GROUP BY ALL
), copies AS (
  SELECT doc_id, source, n_copies, unnest(range(1, n_copies + 1))::INTEGER AS copy FROM counted
)
SELECT doc_id, source, copy, n_copies, ('0x' || substr(md5('{SEED}-order:' || doc_id || ':' || copy), 1, 13))::BIGINT AS shuffle_key FROM copies
"""
