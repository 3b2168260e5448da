"""Radii at which a segment has more masks than buckets, or more than a plan should hold; and identifiers that are no numbers."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import hamming_search, near_dedup, warc


def brute(vectors, asked, k):
    sign = vectors >= 0
    out = {}
    for q in asked:
        order = sorted((int((sign[q] != sign[i]).sum()), i) for i in range(len(vectors)) if i != q)
        out |= {(q, rank + 1): pair for rank, pair in enumerate(order[:k])}
    return out


def found_by(df, asked, k, width):
    found = hamming_search.search(df, df.where(F.col("vec_id").isin(asked)), k, width=width).collect()
    return {(r.vec_id, r["rank"]): (r.distance, r.neighbour_id) for r in found}


def clustered(rows=400):
    """Codes near one centre, and one query whose code is its complement: every radius but the last few finds nothing."""
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(64)
    vectors = np.where(rng.random((rows, 64)) < 0.04, -centre, centre)
    vectors[0] = -centre
    return vectors


def frame(spark, vectors):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")


def test_a_far_query_at_a_great_width_ends_soon(spark):
    vectors = clustered()
    df = frame(spark, vectors)
    start = time.monotonic()
    assert found_by(df, [0, 20], 5, 20) == brute(vectors, [0, 20], 5)
    assert time.monotonic() - start < 90


@pytest.mark.parametrize("width", [6, 13])
def test_every_way_to_the_buckets_finds_the_same(spark, monkeypatch, width):
    vectors = np.random.default_rng(3).standard_normal((300, 64))
    df, asked = frame(spark, vectors), [0, 20, 40]
    expected = brute(vectors, asked, 4)
    # One pair of parts would hold everything: let there be many.
    monkeypatch.setattr(hamming_search, "PARTNERS", 7)
    monkeypatch.setattr(hamming_search, "ASKING", 2)
    assert found_by(df, asked, 4, width) == expected
    # Masks as a table in place of a list.
    monkeypatch.setattr(hamming_search, "LISTED", 2)
    assert found_by(df, asked, 4, width) == expected


def test_probes_equal_all_values_at_a_distance(spark, monkeypatch):
    monkeypatch.setattr(hamming_search, "LISTED", 30)
    segments, rng = hamming_search._segments(1, 9), np.random.default_rng(1)
    codes = [int(c) for c in rng.integers(0, 1 << 62, 5)]
    queries = spark.createDataFrame([([c], 9) for c in codes], "query array<long>, bound int")
    # Segment 0 has few buckets, 1 all, the others none.
    few, every = [3, 17, 500, 511], range(512)
    index = spark.createDataFrame([(0, v) for v in few] + [(1, v) for v in every], "segment int, value long")
    buckets = {0: len(few), 1: 512}
    for radius in (0, 2, 4, 9):
        found = hamming_search._probes(queries, len(codes), index, buckets, segments, radius).join(index, ["segment", "value"]).collect()
        got = sorted((r["query"][0], r["segment"], r["value"]) for r in found)
        own = {(c, place): (c >> segments[place][1]) & 511 for c in codes for place in (0, 1)}
        expected = [(c, p, v) for (c, p), mine in own.items() for v in (few, every)[p] if (mine ^ v).bit_count() == radius]
        assert got == sorted(expected)


def test_identifiers_that_are_no_numbers_are_refused(spark, tmp_path):
    vectors = spark.createDataFrame([("a", [1.0])], "vec_id string, embedding array<double>")
    with pytest.raises(ValueError, match="vec_id must hold whole numbers, not string"):
        hamming_search.search(vectors, vectors)
    docs = spark.createDataFrame([("a", "some text")], "doc_id string, text string")
    with pytest.raises(ValueError, match="doc_id must hold whole numbers"):
        near_dedup.near_duplicates(docs)
    pages = spark.createDataFrame([("a", "http://x", "<p>")], "page_id string, url string, html string")
    with pytest.raises(ValueError, match="page_id must hold whole numbers"):
        warc.write_pages(pages, str(tmp_path / "archive"))
