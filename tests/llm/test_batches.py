"""Python steps hold batches of bounded size, however long the texts are."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larder.llm import line_dedup
from larder.llm.common import BATCH, BATCH_BYTES, text_udf

LENGTH = 100_000


@pytest.fixture
def unlimited(spark):
    """The session without a limit on Arrow batches, as it starts."""
    before = spark.conf.get(BATCH, None)
    spark.conf.unset(BATCH)
    yield spark
    spark.conf.unset(BATCH)
    if before:
        spark.conf.set(BATCH, before)


def sizes(spark):
    """For each text of ``LENGTH`` characters the characters of its batch."""
    def start():
        return lambda batch: pa.array([sum(map(len, batch))] * len(batch), pa.int64())

    docs = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), LENGTH).alias("text"))
    return [r[0] for r in docs.select(text_udf(start, "long")("text")).collect()]


def test_texts_come_in_batches_of_bounded_size(unlimited):
    found = sizes(unlimited)
    assert len(found) == 400 and LENGTH < max(found) <= BATCH_BYTES + LENGTH


def test_a_limit_of_the_session_stays(unlimited):
    unlimited.conf.set(BATCH, "1m")
    found = sizes(unlimited)
    assert len(found) == 400 and LENGTH < max(found) <= (1 << 20) + LENGTH
    assert unlimited.conf.get(BATCH) == "1m"


def test_lines_are_read_in_batches_of_bounded_size(unlimited):
    docs = unlimited.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), LENGTH).alias("text"))
    assert line_dedup._keys(docs, line_dedup.index_keys).select("id").distinct().count() == 1
    assert int(unlimited.conf.get(BATCH)) == BATCH_BYTES
