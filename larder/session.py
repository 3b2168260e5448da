"""Session set-up and the shared folder for written tables."""

from __future__ import annotations

import atexit
import contextlib
import functools
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "larder", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with the settings the library is tested with.

    On a cluster leave ``master`` and ``partitions`` unset: both come from
    spark-submit, and AQE sizes the shuffles.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where it is unset a local master gets a temporary folder, removed at exit, as
    driver and executors are one process there; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@functools.cache
def _local_dir(application_id: str) -> str:
    folder = tempfile.mkdtemp(prefix=f"larder-{application_id}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Text is written compressed, and a compressed file is read by one task: a file ends after so many rows.
TEXT_OPTIONS = {"compression": "lz4", "maxRecordsPerFile": 1_000_000}


@contextlib.contextmanager
def open_folders(spark: SparkSession, most: int):
    """Partitioned writes inside keep the files of up to ``most`` folders open per task; rows are sorted by folder only beyond that."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Runs ``df`` now, writes it to the shared folder and reads it back.

    For a small result that several later steps need: each step would otherwise
    compute it again, with whatever columns the optimizer leaves it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
