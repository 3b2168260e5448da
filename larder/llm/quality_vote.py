"""Document quality by nearest-neighbour voting in a latent-semantic space.

Terms are hashed byte trigrams of the text and markers of its build (share of words that repeat the word before, share of
capitals, of letters, of lines). Term weights are log(1 + count) * idf, idf counted over all documents. A truncated
singular value decomposition of the labelled sample gives the latent space.

The sample holds at most ``SAMPLE`` labelled documents, those of smallest hash; its vectors and labels are sent to all
tasks (``SAMPLE`` x ``RANK`` numbers at most). Every document is scored against the whole sample: exact cosine products,
``ROWS`` documents at a time, and the ``NEIGHBOURS`` nearest vote with their similarity as weight.

Defined results: null and empty texts have no neighbour and get the share of label 1 in the sample, as do all
documents when nothing is labelled (then 0.5); of equally near neighbours at the last place some vote, the same ones each time; labels of documents that
don't exist, null labels and repeated rows do no harm; an empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

import operator
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import crc_mod, strings, table, text_udf

TERMS, MARKERS, RANK = 1 << 13, 64, 64
# The most labelled documents, and the most documents of one product: both bound memory.
SAMPLE, ROWS = 3000, 256
NEIGHBOURS = 15
THRESHOLD = 0.3
SEED = 11
BLOCK = 1 << 22


def term_counts(text: str) -> np.ndarray:
    """Counts of the hashed terms of a text, markers at the end. Zero for an empty text."""
    counts = np.zeros(TERMS + MARKERS, np.float32)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if not len(raw):
        return counts
    for start in range(0, len(raw), BLOCK):
        part = raw[start : start + BLOCK + 2].astype(np.uint32)
        if len(part) < 3:
            continue
        h = (part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(0x9E3779B1)
        counts[:TERMS] += np.bincount(h >> np.uint32(32 - 13), minlength=TERMS)
    words = text.split()
    repeats = sum(map(operator.eq, words, words[1:])) / max(1, len(words) - 1)
    upper = ((raw >= 65) & (raw <= 90)).mean()
    letters = ((raw | 32 >= 97) & (raw | 32 <= 122) | (raw >= 128)).mean()
    spread = len(set(words)) / max(1, len(words))
    for place, share in enumerate((repeats, upper, 1.0 - letters, 1.0 - spread)):
        # A marker counts as much as the trigrams of the text together, on the step its share is on.
        counts[TERMS + 16 * place + min(15, int(share * 16))] = len(raw)
    return counts


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, and how many documents there are. One line per task and term is shuffled."""

    def run(batches):
        total, n = np.zeros(TERMS + MARKERS, np.int64), 0
        for batch in batches:
            for text in strings(batch.column("text")):
                total += term_counts(text) > 0
                n += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array([*used.tolist(), -1], pa.int32()), "n": pa.array([*total[used].tolist(), n], pa.int64())})

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counted.collect()}
    return np.array([found.get(i, 0) for i in range(TERMS + MARKERS)], float), found.get(-1, 0)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (np.log1p(counts) * idf).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def latent_space(X: np.ndarray, rank: int = RANK) -> np.ndarray:
    """The leading right singular vectors of ``X``, by randomised subspace iteration."""
    rank = min(rank, *X.shape)
    Y = X @ np.random.default_rng(SEED).standard_normal((X.shape[1], min(rank + 16, X.shape[1]))).astype(np.float32)
    for _ in range(3):
        Q, _ = np.linalg.qr(Y)
        Y = X @ (X.T @ Q)
    Q, _ = np.linalg.qr(Y)
    _, _, V = np.linalg.svd(Q.T @ X, full_matrices=False)
    return V[:rank].T.astype(np.float32)


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """At most ``SAMPLE`` labelled documents (order, label, text)."""
    known = labels.where(usable & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("double").alias("label"))
    # Labels of documents that don't exist take no places.
    known = known.join(docs.select(id_col), id_col, "left_semi").withColumn("order", F.xxhash64(F.lit(SEED), F.col(id_col)))
    n = known.count()
    some = known.where(F.pmod("order", F.lit(max(1, n // (2 * SAMPLE)))) == 0).orderBy("order").limit(SAMPLE)
    return docs.select(F.col(id_col), F.col(text_col).alias("text")).join(some, id_col).groupBy("order", "label").agg(F.max("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> dict:
    """idf, latent space, sample vectors and labels, as plain arrays."""
    df, n = document_frequencies(docs, text_col)
    idf = np.log((1.0 + n) / (1.0 + df)).astype(np.float32) + 1.0
    kind = pa.struct([("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.float32()))])

    def start():
        def bag(text: str) -> dict:
            counts = term_counts(text)
            used = np.flatnonzero(counts)
            return {"terms": used.astype(np.int32), "counts": counts[used]}

        return lambda batch: pa.array([bag(t) for t in batch], kind)

    sample = labelled_sample(docs, labels, usable, id_col, text_col, label_col)
    rows = sample.select("order", "label", text_udf(start, "terms array<int>, counts array<float>")("text").alias("bag")).collect()
    rows = sorted((r for r in rows if r["bag"]["terms"]), key=lambda r: r["order"])
    if not rows:
        return {"idf": idf, "space": np.zeros((TERMS + MARKERS, 1), np.float32), "vectors": np.zeros((0, 1), np.float32), "labels": np.zeros(0), "prior": 0.5}
    X = np.zeros((len(rows), TERMS + MARKERS), np.float32)
    for x, r in zip(X, rows):
        x[r["bag"]["terms"]] = r["bag"]["counts"]
    X = _unit(weighted(X, idf))
    space = latent_space(X)
    y = np.array([r["label"] for r in rows])
    return {"idf": idf, "space": space, "vectors": _unit(X @ space), "labels": y, "prior": float(y.mean())}


def vote(rows: np.ndarray, model: dict, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest sample vectors, for latent rows."""
    near = _unit(rows) @ model["vectors"].T
    k = min(neighbours, near.shape[1])
    if k == 0:
        return np.full(len(rows), model["prior"])
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(near, top, axis=1), 0.0).astype(float)
    total = weight.sum(axis=1)
    return np.where(total > 0, (weight * model["labels"][top]).sum(axis=1) / np.maximum(total, 1e-12), model["prior"])


def scored(text: Column, model: dict, spark: SparkSession) -> Column:
    """Score of a text column, 0 to 1."""
    sent = spark.sparkContext.broadcast(model)

    def start():
        m = sent.value

        def step(batch: list[str]) -> pa.Array:
            out = []
            for at in range(0, len(batch), ROWS):
                counts = np.stack([term_counts(t) for t in batch[at : at + ROWS]])
                out.append(vote(weighted(counts, m["idf"]) @ m["space"], m))
            return pa.array(np.clip(np.concatenate(out), 0.0, 1.0), pa.float64())

        return step

    return text_udf(start, "double")(text)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from labels whose crc32(doc_id) mod 5 is not 0; per document doc_id, held_out, score, predicted."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    model = fit(docs, labels, ~held_out)
    found = docs.select("doc_id", held_out.alias("held_out"), scored(F.col("text"), model, spark).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
