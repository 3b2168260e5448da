"""Near-duplicate documents: MinHash bands, sequential Bayesian verification of candidates, exact confirmation.

A document is its set of word shingles. Documents with equal sets form a class, whose smallest identifier stands for it.
Representatives that agree in all hashes of a band are candidates. A pair's signatures are compared ``BATCH`` hashes at
a time; it is pruned once the posterior probability of a similarity at the threshold or above, under a uniform prior,
falls below ``MISS``. Survivors are confirmed on their full sets. Links are closed to components.

No bucket is ever paired within itself row by row. First every member of a bucket is compared with the bucket's smallest
and largest one only, which merges true groups of copies, however large. Buckets that still hold several components are
then compared block by block inside tasks, pairs of one component excepted, first by signatures, then, for members with a
candidate left, on their sets; what leaves a task is no more than the links that join its components.

Chance of missing a link at the threshold itself: (1 - 0.85^5)^25 < 1e-6 by the bands and ``MISS`` per batch by pruning; at a
threshold of 0.8 the bands miss 5e-5 of the links that are not above it.

Defined results: texts without words and rows without identifier are linked with nothing and kept; rows that repeat an
identifier are one document; an empty table gives an empty result. Texts are read whole. Identifiers are whole numbers:
others raise an error before anything runs.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import packed, table, text_udf, unpacked, whole_numbers
from larder.llm.components import components
from larder.session import materialize

WORDS = 5
BANDS, PER_BAND, BATCH = 25, 5, 25
MISS = 1e-6
SIMILARITY = 85  # per cent
# The most members of a block, about, and the most shingles of their sets.
BLOCK, BLOCK_SHINGLES = 512, 1_000_000
CACHE_WORDS = 300_000
SEED = 2024


class Shingles:
    """Sets of hashed shingles, and their MinHash signatures."""

    def __init__(self, words: int = WORDS):
        import xxhash

        self.width, self.hash, self.known = words, xxhash.xxh3_64_intdigest, {}
        rng = np.random.default_rng(SEED)
        n = BANDS * PER_BAND
        self.times = rng.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = rng.integers(0, 2**63, n, np.uint64)
        self.fold = rng.integers(0, 2**63, PER_BAND, np.uint64) * np.uint64(2) + np.uint64(1)

    def words(self, text: str) -> np.ndarray:
        known, out = self.known, []
        for word in text.encode("utf-8", "replace").lower().split():
            h = known.get(word)
            if h is None:
                h = self.hash(word)
                if len(known) >= CACHE_WORDS:
                    known.clear()
                known[word] = h
            out.append(h)
        return np.array(out, np.uint64)

    def set_of(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles; one of the whole text where it has fewer words, none without words."""
        words = self.words(text)
        if not len(words):
            return words
        width = min(self.width, len(words))
        h = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            h = (h ^ words[i : len(words) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
        return np.unique(h)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """Smallest hash of the set under each hash function, in blocks of bounded memory."""
        least = np.full(len(self.times), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 4096):
            part = shingles[at : at + 4096, None] * self.times + self.plus
            np.minimum(least, (part ^ part >> np.uint64(31)).min(axis=0), out=least)
        return least

    def bands(self, least: np.ndarray) -> np.ndarray:
        rows = least.reshape(BANDS, PER_BAND)
        h = np.arange(BANDS, dtype=np.uint64)
        for i in range(PER_BAND):
            h = (h ^ rows[:, i]) * self.fold[i]
            h ^= h >> np.uint64(31)
        return h.view(np.int64)


def least_matches(threshold: float = SIMILARITY / 100, miss: float = MISS) -> list[tuple[int, int]]:
    """(n, m) per batch: with fewer than m of n hashes equal, P(similarity >= threshold) is below ``miss``.

    Under a uniform prior that probability is P(Binomial(n + 1, threshold) <= matches).
    """
    out = []
    for n in range(BATCH, BANDS * PER_BAND + 1, BATCH):
        total, m = 0.0, 0
        for k in range(n + 1):
            total += math.comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k)
            if total >= miss:
                m = k
                break
        out.append((n, m))
    return out


def survivors(left: np.ndarray, right: np.ndarray, limits: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of signature rows are not pruned, and their equal hashes; a pair's later batches are read only while it lives."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    start = 0
    for n, least in limits:
        matches = matches + (left[alive, start:n] == right[alive, start:n]).sum(axis=1)
        keep = matches >= least
        alive, matches, start = alive[keep], matches[keep], n
    return alive, matches


def similar(x: np.ndarray, y: np.ndarray, similarity: int = SIMILARITY) -> bool:
    """Whether two sorted sets are similar enough."""
    if 100 * min(len(x), len(y)) < similarity * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= similarity * (len(x) + len(y) - both)


def _signatures(column: pa.Array) -> np.ndarray:
    width = 2 * BANDS * PER_BAND
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, width // 2)


def features(text: Column) -> Column:
    """Struct of a text: size of its set, a 128-bit key of the set, band keys and the low 16 bits of each hash."""
    kind = pa.struct([("n", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])

    def start():
        import xxhash

        shingles = Shingles()

        def one(text: str) -> dict:
            found = shingles.set_of(text)
            if not len(found):
                return {"n": 0, "key": None, "bands": None, "sig": None}
            least = shingles.signature(found)
            return {"n": len(found), "key": xxhash.xxh3_128_digest(found.tobytes()), "bands": shingles.bands(least), "sig": least.astype(np.uint16).tobytes()}

        return lambda batch: pa.array([one(t) for t in batch], kind)

    return text_udf(start, "n long, key binary, bands array<long>, sig binary")(text)


def sets(text: Column) -> Column:
    """The shingle set of a text, as hashes."""

    def start():
        shingles = Shingles()
        return lambda batch: pa.array([shingles.set_of(t).view(np.int64) for t in batch], pa.list_(pa.int64()))

    return text_udf(start, "array<long>")(text)


def _with(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with the column of both ends."""
    one = values.select(F.col("id").alias("a"), F.col(column).alias("left"))
    other = values.select(F.col("id").alias("b"), F.col(column).alias("right"))
    return pairs.join(one, "a").join(other, "b")


def _bayes(pairs: DataFrame, signatures: DataFrame, similarity: int) -> DataFrame:
    limits = least_matches(similarity / 100)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                alive, _ = survivors(_signatures(batch.column("left")), _signatures(batch.column("right")), limits)
                yield batch.select(["a", "b"]).take(pa.array(alive))

    return _with(pairs, signatures, "sig").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose full sets are similar enough. Sets are made of the texts that occur in a pair."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    involved = materialize(ends, "ends")
    whole = materialize(texts.join(involved, "id", "left_semi").select("id", sets(F.col("text")).alias("shingles")), "sets")

    def run(batches):
        for batch in batches:
            keep = [similar(x.values.to_numpy(), y.values.to_numpy(), similarity) for x, y in zip(batch.column("left"), batch.column("right"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _with(pairs, whole, "shingles").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _block_pairs(members: DataFrame) -> DataFrame:
    """Members (key, id, label, sig, bands, n, ...) packed into blocks of bounded size, and all pairs of blocks of a bucket."""
    sizes = members.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("volume"))
    pieces = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("volume") / BLOCK_SHINGLES))
    block = F.when(pieces <= 1, 0).otherwise(F.pmod(F.xxhash64("id"), 2 * pieces)).cast("int")
    fields = [c for c in members.columns if c not in ("key", "n")]
    blocks = members.join(sizes, "key").groupBy("key", block.alias("block")).agg(F.collect_list(F.struct(*fields)).alias("members"))
    blocks = materialize(blocks, "blocks")
    other = blocks.withColumnsRenamed({"members": "right", "block": "other"})
    pairs = blocks.withColumnRenamed("members", "left").join(other, "key").where("block <= other")
    return pairs.select("key", (F.col("block") == F.col("other")).alias("same"), "left", "right")


def _candidates(batch: pa.RecordBatch, at: int, limits: list[tuple[int, int]]):
    """Of one pair of blocks: both sides' fields, and the places and equal hashes of surviving pairs of different components.

    Two members can meet in several buckets: they count in that of their first common band only.
    """
    key, same = batch.column("key")[at].as_py(), batch.column("same")[at].as_py()
    sides = [batch.column(c).slice(at, 1).flatten() for c in ("left", "right")]
    ids, labels = ([s.field(f).to_numpy() for s in sides] for f in ("id", "label"))
    marks = [_signatures(s.field("sig")) for s in sides]
    bands = [s.field("bands").flatten().to_numpy().reshape(-1, BANDS) for s in sides]
    found = []
    for start in range(0, len(ids[0]), 64):
        some = slice(start, start + 64)
        differ = labels[0][some, None] != labels[1][None, :]
        if same:
            differ &= ids[0][some, None] < ids[1][None, :]
        i, j = np.nonzero(differ)
        alive, matches = survivors(marks[0][some][i], marks[1][j], limits)
        i, j = i[alive] + start, j[alive]
        common = bands[0][i] == bands[1][j]
        here = bands[0][i, common.argmax(axis=1)] == key if len(i) else np.empty(0, bool)
        found.append((i[here], j[here], matches[here]))
    return sides, ids, labels, *(np.concatenate(c) for c in zip(*found))


def _open_ends(members: DataFrame, similarity: int) -> DataFrame:
    """Identifiers of members with a surviving candidate in another component of their bucket."""
    limits = least_matches(similarity / 100)

    def run(batches):
        for batch in batches:
            out = [np.empty(0, np.int64)]
            for at in range(batch.num_rows):
                _, ids, _, i, j, _ = _candidates(batch, at, limits)
                out += [np.unique(ids[0][i]), np.unique(ids[1][j])]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], ["id"])

    return _block_pairs(members).mapInArrow(run, "id long").distinct()


def _across(members: DataFrame, similarity: int) -> DataFrame:
    """Links between different components of a bucket, confirmed inside the task on the members' sets.

    The most similar candidates come first; two components that a link of these blocks has joined need no second one, so
    a pair of blocks gives no more links than it has members.
    """
    limits = least_matches(similarity / 100)

    def run(batches):
        for batch in batches:
            out = ([], [])
            for at in range(batch.num_rows):
                sides, ids, labels, i, j, matches = _candidates(batch, at, limits)
                sets_of = [s.field("shingles") for s in sides]
                joined: dict[int, int] = {}

                def root(label):
                    while label in joined:
                        label = joined[label]
                    return label

                for k in np.argsort(-matches, kind="stable"):
                    p, q = root(labels[0][i[k]]), root(labels[1][j[k]])
                    if p != q and similar(sets_of[0][i[k]].values.to_numpy(), sets_of[1][j[k]].values.to_numpy(), similarity):
                        joined[p] = q
                        out[0].append(ids[0][i[k]])
                        out[1].append(ids[1][j[k]])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in out], ["a", "b"])

    return _block_pairs(members).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept. ``similarity``: least share of common shingles, in per cent."""
    whole_numbers(docs, id_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = materialize(texts.select("id", features(F.col("text")).alias("f")).select("id", "f.*"), "features")
    known = found.where(F.col("id").isNotNull() & F.col("key").isNotNull())
    classes = materialize(known.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("size")), "classes")

    # Only the row of the representative has the class's key and identifier alike.
    reps = known.join(classes.select("key", F.col("rep").alias("id")), ["key", "id"], "left_semi").dropDuplicates(["id", "key"])
    signatures = reps.select("id", "sig")
    members = reps.select(F.explode("bands").alias("key"), "id")
    buckets = members.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last")
    members = materialize(members.join(buckets, "key"), "members")

    stars = members.select("key", F.col("id").alias("b"), F.explode(F.array("first", "last")).alias("a")).where("a <> b")
    stars = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = materialize(_confirmed(materialize(_bayes(stars, signatures, similarity), "pairs"), texts, similarity), "links")
    labels = components(links).withColumnRenamed("component", "label")

    labelled = members.select("key", "id").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    labelled = materialize(labelled, "labelled")
    # A bucket of two was compared by its star already.
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")).where("low <> high AND size > 2").select("key")
    marks = reps.select("id", "sig", "bands", "n")
    open_members = labelled.join(mixed, "key", "left_semi").join(marks, "id").select("key", "id", "label", "sig", "bands", "n")
    # Sets are needed of those members only that have a candidate left.
    ends = materialize(_open_ends(open_members, similarity), "ends")
    whole = materialize(texts.join(ends, "id", "left_semi").select("id", sets(F.col("text")).alias("shingles")), "sets")
    rest = _across(open_members.join(whole, "id"), similarity)
    links = links.unionByName(materialize(rest, "links"))
    groups = components(links)

    # Classes first, so that each document meets one line; a class of very many copies is a skewed join, which AQE splits.
    named = classes.join(groups.withColumnRenamed("id", "rep"), "rep", "left").select("key", F.coalesce("component", "rep").alias("component"), "size")
    several = named.where((F.col("size") > 1) | F.col("component").isNotNull())
    result = found.select("id", "n", "key").join(several, "key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return result.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """The documents of smallest identifier of each group, with their columns."""
    dropped = near_duplicates(docs, id_col, text_col, similarity).where(~F.col("kept")).select(F.col(id_col).alias("dropped_id")).distinct()
    rows = packed(docs, id_col).withColumnRenamed(id_col, "kept_id")
    return unpacked(rows.join(dropped, F.col("kept_id") == F.col("dropped_id"), "left_anti"), docs.columns)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
