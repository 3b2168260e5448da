"""Run history: every run adds a ``run_id`` partition to the result tables.

Layout: ``<base>/<table>/run_id=<YYYYMMDD_HHMMSS>/part-*``. Reading one run
prunes the others, and writing a run again replaces only its own partition, so a
restarted job leaves no double rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_ID_FORMAT = "%Y%m%d_%H%M%S"


def new_run_id(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now()).strftime(RUN_ID_FORMAT)


def write_run(df: DataFrame, base: str, table: str, run_id: str, fmt: str, files: int | None = None) -> str:
    """Writes one result table of a run and returns the table's path.

    ``files`` is the number of files, for results of a few rows a product; others have one per task.
    """
    path = f"{base}/{table}"
    df = df if files is None else df.coalesce(files)
    writer = (
        df.withColumn("run_id", F.lit(run_id)).write.partitionBy("run_id")
        .mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
    )
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def read_table(spark: SparkSession, base: str, table: str, fmt: str, schema: str) -> DataFrame:
    reader = spark.read.schema(f"{schema}, run_id string").format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(f"{base}/{table}")


def run_files(spark: SparkSession, base: str) -> DataFrame:
    """Files of all runs: run, table, kind and size. Contents are not read."""
    path = F.col("path")

    def part(pattern: str) -> Column:
        return F.regexp_extract(path, pattern, 1)

    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*")
        .load(base)
        .select(
            part(r"run_id=([^/]+)/").alias("run_id"),
            part(r"([^/]+)/run_id=").alias("table"),
            part(r"/([^/]+)$").alias("fichier"),
            part(r"\.([a-z]+)$").alias("type"),
            (F.col("length") / 1024.0).alias("taille_ko"),
        )
        .where(F.col("run_id") != "")
    )


def summary_lines(summary: DataFrame) -> DataFrame:
    """Key/value lines of each product's summary."""
    names = [c for c in summary.columns if c != "nom_produit"]
    pairs = F.array(*[
        F.struct(F.lit(n).alias("cle"), F.col(n).cast("string").alias("valeur")) for n in names
    ])
    return summary.select(F.col("nom_produit").alias("produit"), F.inline(pairs)).where(F.col("valeur").isNotNull())


def as_text(lines: DataFrame) -> DataFrame:
    return lines.select(F.concat_ws(" | ", "produit", F.concat_ws(": ", "cle", "valeur")).alias("value"))


def run_history(spark: SparkSession, base: str, products: DataFrame, limit: int = 10) -> DataFrame:
    """Latest runs first, with their tables by kind and the number of products.

    A table counts once, however many part files it has. ``products`` is any
    result table with ``run_id`` and ``produit``.
    """
    kinds = {"nb_graphs": "png", "nb_csv": "csv", "nb_json": "json", "nb_txt": "txt"}
    found = run_files(spark, base)
    # The newest runs come first: the others' files and rows are left out before anything is counted.
    newest = [r["run_id"] for r in found.select("run_id").distinct().orderBy(F.desc("run_id")).limit(limit).collect()]
    found, products = (df.where(F.col("run_id").isin(newest)) for df in (found, products))
    tables = found.groupBy("run_id", "table", "type").agg(
        F.count("*").alias("nb_fichiers"), F.sum("taille_ko").alias("taille_ko"))
    files = tables.groupBy("run_id").agg(
        *[F.count_if(F.col("type") == ext).alias(name) for name, ext in kinds.items()],
        F.sum("nb_fichiers").alias("nb_fichiers"),
        F.sum("taille_ko").alias("taille_ko"),
    )
    covered = products.groupBy("run_id").agg(F.count_distinct("produit").alias("nb_produits"))
    return files.join(covered, "run_id", "left").orderBy(F.desc("run_id"))
