"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

Subwords are the character 1- to 3-grams of a lower-cased word with its borders, hashed into ``BUCKETS`` embeddings. A
document is the mean of the embeddings of all its subwords; a linear softmax gives one probability per language. Both are
trained by stochastic gradient descent in NumPy on a bounded sample of the labelled rows: at most ``SAMPLE`` per language and
``TOTAL`` of all, shared evenly, the smallest by hash. More than ``MOST_LANGUAGES`` languages stop the job. A fifth of it is set aside to calibrate: it gives the temperature of the softmax and the
confidence below which a prediction is rejected.

Scoring is one pass over the documents. As the softmax is linear, mean(E[h]) @ W equals mean((E @ W)[h]): tasks get the
product, one row per bucket and one column per language, while that is no larger than E; else both factors.

Defined results: a null, empty or letterless text is ``und`` with score 0 and rejected; documents with null language are
scored but never learnt from; without any labelled row all are ``und``; ties go to the first language by name; an empty
table gives an empty result. Texts are read whole, in blocks of ``BLOCK`` characters.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from larder.llm.common import crc_mod, packed, table, text_udf, unpacked

BUCKETS, DIM, ORDERS = 1 << 15, 16, (1, 2, 3)
# The most training documents per language and in total, and the most languages: they bound what reaches the driver.
SAMPLE, TOTAL, MOST_LANGUAGES = 400, 160_000, 8000
# The most logits that calibration holds at once.
AT_ONCE = 4_000_000
EPOCHS, RATE, SEED = 6, 0.5, 5
CALIBRATION_SHARE = 0.2
# The share of calibration documents that rejection may cost, and the confidence above which nothing is rejected.
REJECTED_SHARE, SURE = 0.002, 0.5
UNKNOWN = "und"
BLOCK = 1 << 20


class Subwords:
    """Hashed subwords of texts, as one array with its borders."""

    def __init__(self):
        import unicodedata

        self.letter = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
        marks = [i for i in range(0x300, 0x20000) if unicodedata.category(chr(i))[0] == "M"]
        self.inside = self.letter.copy()
        self.inside[marks] = True

    def codes(self, text: str) -> tuple[np.ndarray, bool]:
        """Code points with one space for everything that is no letter, a space at both ends; whether there is a letter."""
        raw = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
        return np.where(self.inside[raw], raw, np.uint32(32)), bool(self.letter[raw].any())

    @staticmethod
    def hashed(codes: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Buckets of the subwords that begin at start..stop. Only their ends may be spaces."""
        found = []
        for n in ORDERS:
            last = min(stop, len(codes) - n + 1)
            if last <= start:
                continue
            parts = [codes[start + i : last + i] for i in range(n)]
            if n == 1:
                keep = parts[0] != 32
            elif n == 2:
                keep = (parts[0] != 32) | (parts[1] != 32)
            else:
                keep = np.logical_and.reduce([p != 32 for p in parts[1:-1]])
            h = np.full(last - start, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for p in parts:
                h = (h ^ p) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(13)
            h = h * np.uint32(0xC2B2AE35)
            found.append((h >> np.uint32(32 - 15))[keep])
        return np.concatenate(found) if found else np.empty(0, np.uint32)

    def blocks(self, codes: np.ndarray):
        for start in range(0, len(codes), BLOCK):
            yield self.hashed(codes, start, start + BLOCK)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # one row per bucket, one column per language or, with heads, per dimension
    heads: np.ndarray | None  # one row per dimension, one column per language
    temperature: float
    threshold: float


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(bags: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Stochastic gradient descent over documents (buckets, shares); returns embeddings times softmax weights, or both of many languages."""
    rng = np.random.default_rng(SEED)
    E = rng.uniform(-1.0 / DIM, 1.0 / DIM, (BUCKETS, DIM)).astype(np.float32)
    W = np.zeros((DIM, classes), np.float32)
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            rate = RATE * (1.0 - done / steps)
            done += 1
            buckets, share = bags[i]
            if not len(buckets):
                continue
            rows = E[buckets]
            mean = share @ rows
            slope = _softmax(mean @ W)
            slope[target[i]] -= 1.0
            back = W @ slope
            W -= rate * np.outer(mean, slope)
            # The step of an embedding is divided by the largest share, not by the count of subwords.
            E[buckets] = rows - rate * (share / share.max())[:, None] * back
    return (E @ W, None) if classes <= DIM else (E, W)


def calibrate(inputs: np.ndarray, heads: np.ndarray | None, target: np.ndarray) -> tuple[float, float]:
    """The temperature of least log loss, and the confidence below which a prediction is rejected. Without heads, inputs are logits."""
    if not len(inputs):
        return 1.0, 0.0
    step = max(1, AT_ONCE // (inputs if heads is None else heads).shape[1])
    parts = [slice(at, at + step) for at in range(0, len(inputs), step)]

    def logits(part: slice) -> np.ndarray:
        return inputs[part] if heads is None else inputs[part] @ heads

    grid = np.exp(np.linspace(np.log(0.05), np.log(20.0), 120))
    loss = np.zeros(len(grid))
    for part in parts:
        some, wanted = logits(part), target[part]
        loss += [-np.log(_softmax(some / t)[np.arange(len(wanted)), wanted] + 1e-12).sum() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    confidence = np.concatenate([_softmax(logits(part) / temperature).max(axis=1) for part in parts])
    return temperature, float(min(np.quantile(confidence, REJECTED_SHARE), SURE))


def _sample(docs: DataFrame, usable: Column, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """At most ``SAMPLE`` usable rows per language, ``TOTAL`` in all: those of smallest hash, thinned out before they meet."""
    known = docs.where(usable & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    # Of identifier and text, as identifiers may repeat.
    order = F.xxhash64(F.lit(SEED), F.col(id_col), F.col(text_col))
    sizes = known.groupBy(F.col(label_col).alias("language")).agg(F.count("*").alias("n"), F.min(order).alias("least")).limit(MOST_LANGUAGES + 1).collect()
    if not sizes:
        return known.select(F.lit("").alias("language"), F.col(text_col).alias("text"), order.alias("order"), F.lit(1).alias("place")).limit(0)
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"{label_col} has more than {MOST_LANGUAGES} languages")
    most = min(SAMPLE, TOTAL // len(sizes))
    # Twice the rows wanted of each language, by hash, so that the ranking below gets few; the smallest hash of a language always
    # passes, so that none is lost whose rows are all alike.
    every = [(r["language"], max(1, r["n"] // (2 * most)), r["least"]) for r in sizes]
    kind = StructType([StructField("sized", known.select(label_col).schema[0].dataType), StructField("every", LongType()), StructField("least", LongType())])
    # One row per language.
    thinned = F.broadcast(docs.sparkSession.createDataFrame(every, kind))
    rows = known.select(F.col(label_col).alias("language"), F.col(text_col).alias("text"), order.alias("order"))
    some = rows.join(thinned, F.col("language") == F.col("sized")).where((F.pmod("order", "every") == 0) | (F.col("order") == F.col("least")))
    first = Window.partitionBy("language").orderBy("order", "text")
    return some.select("language", "text", "order").withColumn("place", F.row_number().over(first)).where(F.col("place") <= most)


def _bags(sample: DataFrame) -> DataFrame:
    """Distinct buckets and their counts, per sampled document."""
    kind = pa.struct([("buckets", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def start():
        subwords = Subwords()

        def bag(text: str) -> dict:
            total = np.zeros(BUCKETS, np.int64)
            for h in subwords.blocks(subwords.codes(text)[0]):
                total += np.bincount(h, minlength=BUCKETS)
            used = np.flatnonzero(total)
            return {"buckets": used.astype(np.int32), "counts": total[used]}

        return lambda batch: pa.array([bag(t) for t in batch], kind)

    return sample.select("language", "place", text_udf(start, "buckets array<int>, counts array<long>")("text").alias("bag")).select("language", "place", "bag.*")


def fit(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Model:
    """Learns from the rows that meet ``usable`` and have a language."""
    rows = sorted(_bags(_sample(docs, usable, id_col, text_col, label_col)).collect(), key=lambda r: (r["place"], r["language"]))
    rows = [r for r in rows if r["buckets"]]
    languages = sorted({r["language"] for r in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), None, 1.0, 0.0)
    bags = []
    for r in rows:
        counts = np.array(r["counts"], np.float32)
        bags.append((np.array(r["buckets"]), counts / counts.sum()))
    number = {language: i for i, language in enumerate(languages)}
    target = np.array([number[r["language"]] for r in rows])
    held = np.array([r["place"] % round(1 / CALIBRATION_SHARE) == 0 for r in rows])
    train_on = np.flatnonzero(~held)
    weights, heads = train([bags[i] for i in train_on], target[train_on], len(languages))
    inputs = np.array([share @ weights[b] for (b, share), h in zip(bags, held) if h]).reshape(-1, weights.shape[1])
    return Model(languages, weights, heads, *calibrate(inputs, heads, target[held]))


def predicted(text: Column, model: Model, spark: SparkSession) -> Column:
    """Struct lang_pred, score, rejected of a text column."""
    sent = spark.sparkContext.broadcast(vars(model))  # plain values only
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def start():
        subwords, m = Subwords(), Model(**sent.value)

        def one(text: str) -> dict:
            codes, letters = subwords.codes(text)
            if not letters or not m.languages:
                return {"lang_pred": UNKNOWN, "score": 0.0, "rejected": True}
            logits, n = np.zeros(m.weights.shape[1]), 0
            for h in subwords.blocks(codes):
                logits += m.weights[h].sum(axis=0, dtype=np.float64)
                n += len(h)
            if m.heads is not None:
                logits = logits @ m.heads
            p = _softmax(logits / n / m.temperature)
            best = int(p.argmax())
            return {"lang_pred": m.languages[best], "score": float(p[best]), "rejected": bool(p[best] < m.threshold)}

        return lambda batch: pa.array([one(t) for t in batch], kind)

    return text_udf(start, "lang_pred string, score double, rejected boolean")(text)


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """The documents whose language is recognised, with their columns. Learns from the documents themselves."""
    model = fit(docs, F.lit(True), id_col, text_col, label_col)
    found = packed(docs).withColumn("found", predicted(F.col("row").getField(text_col), model, docs.sparkSession))
    return unpacked(found.where(~F.col("found.rejected")), docs.columns)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from the documents whose crc32(doc_id) mod 4 is not 2; per document doc_id, held_out, lang_pred, score, rejected."""
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = fit(docs, ~held_out)
    found = docs.select("doc_id", held_out.alias("held_out"), predicted(F.col("text"), model, spark).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", "found.rejected")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
