"""Connected components of links by alternating large and small stars, one exchange of a vertex's links at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import materialize


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every linked vertex; the component is its smallest vertex.

    Each round links all larger neighbours of a vertex to its smallest one, then the smaller ones; rounds go on until
    nothing changes, about the logarithm of the longest chain. The minimum of a vertex's neighbours is a map-side
    aggregation and a vertex with very many links is a skewed join, which AQE splits. Every round is written to the
    shared folder, so its lineage stays short.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "edges")
    before = _fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))
