"""Exact deduplication by a tree of merged digest runs. DataFrame operations only.

Every input partition makes a run: its digests, each once, with the wanted identifier and a count. In each round the runs whose
numbers are ``fan_in ** round`` apart are exchanged to the first of them and merged there: the lines are sorted by digest
and identifier, equal digests lie side by side, and the first of them takes in the counts of the others. With a fan-in of two
these are binomial rounds. A run is cut by digest into ``SLICES`` parts that are exchanged and merged apart, so no task ever
holds a whole run, and as a run has each digest once, a text that makes up a third of all rows is one line per run before the
first round and at most ``fan_in`` lines side by side in each. An exchange keeps no order, so runs are sorted anew where
they are merged.

"Verified": the digest is SHA-256, and each line also carries the smallest and largest length and second hash of its
texts. Where they differ, two texts share a digest and the job stops.

Defined results: a null text counts as empty; rows without identifier never stay while another copy has one
(``keep_id`` is null if none has); rows that repeat an identifier with the same text count in ``group_size`` and are
one document, kept or dropped together; an empty table gives an empty result; other columns are never touched.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import table

RUNS = 64
FAN_IN = 2
SLICES = 4096


def _verified(value: Column) -> Column:
    same = (F.col("_len_lo") == F.col("_len_hi")) & (F.col("_sum_lo") == F.col("_sum_hi"))
    return F.when(same, value).otherwise(F.raise_error(F.lit("two different texts have the same SHA-256 digest")))


def local_runs(rows: DataFrame, keep: str = "smallest", runs: int = RUNS) -> DataFrame:
    """Lines (run, slice, digest, id, n, _len_lo, _len_hi, _sum_lo, _sum_hi): each digest once per run, combined before the exchange."""
    pick = F.min if keep == "smallest" else F.max
    placed = rows.withColumns({
        "run": F.pmod(F.spark_partition_id(), F.lit(runs)).cast("long"),
        "slice": F.pmod(F.xxhash64("digest"), F.lit(SLICES)),
    })
    return placed.groupBy("run", "slice", "digest").agg(
        pick("id").alias("id"), F.count("*").alias("n"),
        F.min("_len").alias("_len_lo"), F.max("_len").alias("_len_hi"),
        F.min("_sum").alias("_sum_lo"), F.max("_sum").alias("_sum_hi"),
    ).withColumn("n", _verified(F.col("n")))


def merge_runs(lines: DataFrame, keep: str = "smallest", runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """Merges the lines of ``local_runs``, whose runs hold each digest once, to one line per digest."""
    wanted_first = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    merged = Window.partitionBy("run", "slice").orderBy("digest", wanted_first)
    distance = 1
    while distance < runs:
        distance *= fan_in
        lines = lines.withColumn("run", F.col("run") - F.pmod("run", F.lit(distance)))

        def others(name: str) -> list[Column]:
            return [F.when(F.lead("digest", k).over(merged) == F.col("digest"), F.lead(name, k).over(merged)) for k in range(1, fan_in)]

        head = ~F.lag("digest").over(merged).eqNullSafe(F.col("digest"))
        counts = functools.reduce(Column.__add__, [F.coalesce(n, F.lit(0)) for n in others("n")], F.col("n"))
        lines = lines.select(
            "run", "slice", "digest", "id", counts.alias("n"),
            *[F.least(c, *others(c)).alias(c) for c in ("_len_lo", "_sum_lo")],
            *[F.greatest(c, *others(c)).alias(c) for c in ("_len_hi", "_sum_hi")], head.alias("_head"),
        ).where("_head").drop("_head").withColumn("n", _verified(F.col("n")))
    return lines


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
                       F.octet_length(text).alias("_len"), F.xxhash64(text).alias("_sum"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    runs: int = RUNS, fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256. ``keep``: smallest or largest identifier."""
    rows = digests(docs, id_col, text_col)
    groups = merge_runs(local_runs(rows, keep, runs), keep, runs, fan_in)
    # Texts that occur once need no partner. A frequent digest on the left is a skewed join, which AQE splits.
    repeated = groups.where("n > 1").select("digest", F.col("id").alias("keep_id"), F.col("n").alias("group_size"), F.lit(True).alias("_group"))
    joined = rows.join(repeated, "digest", "left")
    keep_id = F.when(F.col("_group"), F.col("keep_id")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_col), keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"), keep="largest")


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
