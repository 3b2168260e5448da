"""Removal of word sequences that occur earlier, by matching statistics against suffix automata of reference shards.

A window is ``window`` consecutive words of one document; a word goes if some window covers it whose words also start earlier:
in a smaller document, or earlier in the same one. Only text that may repeat meets an automaton:

1. Each window is represented by its anchor, the ``GRAM`` words in it of smallest hash (the leftmost of equal ones). Equal
   windows have equal anchors, and neighbouring windows mostly share theirs: there is one anchor for some seven words. Windows
   whose anchor occurs once in the table are unique and done with.
2. The passage around the first occurrence of a repeated anchor is a reference. References are dealt to shards of bounded size by
   their document and the piece of it they lie in. The shard's suffix automaton is sent to every task that streams passages
   against it: a shard that very many documents ask for is copied to as many slices as their number needs.
3. All other occurrences of the anchor are streamed through the automaton of its shard, which gives the longest match at each
   word and its first place. A match of a window or more at an earlier place marks the window.
4. A window that repeats, but not at the first occurrence of its anchor, finds no such match. These windows, a few at the borders
   of each repeated passage, meet by a 128-bit digest of their words; the first one stays.

Exact: a window's earlier occurrence is either in the reference (3) or, like itself, left over (4).

Defined results: null and empty texts have no words; texts shorter than a window keep all; rows without identifier have no place
in the order, so they keep all words and no other loses any because of them; rows that repeat an identifier are read as one
document, so equal windows at equal places are no repetition; an empty table gives an empty result; other columns are never
touched. Texts are read whole, and a long text's passages are dealt piece by piece.
"""

from __future__ import annotations

import hashlib
import itertools
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import strings, table, text_udf
from larder.session import materialize

WINDOW, GRAM = 20, 8
# Words of a shard, anchors of a slice, about; and the words after which a document's passages may go to another shard.
SHARD_WORDS, SLICE_ANCHORS, PIECE_BITS = 1 << 16, 1 << 16, 12
# Words whose anchors are sought at once, and remembered hashes.
AT_ONCE, CACHE_WORDS = 1 << 18, 300_000


def words_of(text: str) -> list[bytes]:
    """Words in UTF-8: what lies between blanks, tabs and line breaks."""
    return text.encode("utf-8", "replace").split()


class _Known(dict):
    """Hashes of words, a bounded number of them remembered."""

    def __init__(self):
        import xxhash

        super().__init__()
        self.hash = xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = self.hash(word)
        return h


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, in doubling steps."""
    size = 1
    while 2 * size <= width:
        keys, size = np.minimum(keys[:-size], keys[size:]), 2 * size
    return np.minimum(keys[: len(keys) - (width - size)], keys[width - size :])


class Anchors:
    """Anchors of the windows of texts."""

    def __init__(self, window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram, self.known = window, min(gram, window), _Known()

    def find(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per anchor: its text, hash, the first window that has it, and how many have it; windows of a text follow one another."""
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        if total < self.window:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        single = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(texts)), np.uint64, total)
        grams = total - self.gram + 1
        h = single[:grams].copy()
        for i in range(1, self.gram):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += single[i : grams + i]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        # The upper half of the hash, then the place: the leftmost of the smallest.
        keys = h & np.uint64(0xFFFFFFFF00000000) | np.arange(grams, dtype=np.uint64)
        place = (sliding_least(keys, self.window - self.gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        windows = np.arange(len(place))
        text = np.searchsorted(ends, windows, side="right")
        inside = windows + self.window <= ends[text]
        windows, place, text = windows[inside], place[inside], text[inside]
        first = np.flatnonzero(np.diff(place, prepend=-1))
        low = windows[first] - (ends - lengths)[text[first]]
        return text[first], h[place[first]].view(np.int64), low.astype(np.int32), np.diff(np.append(first, len(place))).astype(np.int32)


class Automaton:
    """Suffix automaton of several passages, with the first place at which each state's words end."""

    def __init__(self, passages: Iterable[tuple]):
        """``passages``: document, place of its first word, words."""
        self.word: dict[bytes, int] = {}
        self.next, self.link, self.length = [{}], [-1], [0]
        ends: list[tuple | None] = [None]
        last = 0
        for number, (doc, start, words) in enumerate(passages):
            for place, word in enumerate(words, start):
                last = self._extend(last, self.word.setdefault(word, len(self.word)))
                ends += [None] * (len(self.next) - len(ends))
                ends[last] = (doc, place)
            # Words of two passages never meet: each border is a word of its own.
            last = self._extend(last, -1 - number)
            ends += [None] * (len(self.next) - len(ends))
        for state in sorted(range(1, len(ends)), key=self.length.__getitem__, reverse=True):
            end, up = ends[state], self.link[state]
            if end is not None and up > 0 and (ends[up] is None or end < ends[up]):
                ends[up] = end
        self.first = ends

    def _extend(self, last: int, word: int) -> int:
        following, link, length = self.next, self.link, self.length
        new = len(following)
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and word not in following[at]:
            following[at][word] = new
            at = link[at]
        if at >= 0:
            target = following[at][word]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                copy = len(following)
                following.append(dict(following[target]))
                link.append(link[target])
                length.append(length[at] + 1)
                while at >= 0 and following[at].get(word) == target:
                    following[at][word] = copy
                    at = link[at]
                link[target] = link[new] = copy
        return new

    def matches(self, words: list[bytes], longest: int) -> Iterator[tuple[int, tuple | None]]:
        """Matching statistics: at each word the length of the longest match that ends there, and its first place.

        Matches beyond ``longest`` words are cut to no less than that, so that the place is the first one of so many words.
        """
        following, link, length, first, number = self.next, self.link, self.length, self.first, self.word
        state = matched = 0
        for word in words:
            w = number.get(word)
            if w is None:
                state = matched = 0
            else:
                while state and w not in following[state]:
                    state = link[state]
                    matched = length[state]
                state = following[state].get(w, 0)
                matched = matched + 1 if state else 0
                while state and length[link[state]] >= longest:
                    state = link[state]
                    matched = length[state]
            yield matched, first[state]


# --- the steps ------------------------------------------------------------------


def anchors_of(text: Column, window: int) -> Column:
    """Array of (h, low, n): the anchors of a text column, with the windows that have them."""
    kind = pa.struct([("h", pa.int64()), ("low", pa.int32()), ("n", pa.int32())])

    def start():
        anchors = Anchors(window)

        def step(batch: list[str]) -> pa.Array:
            found, counts, some, size = [anchors.find([])[1:]], [], [], 0
            for place, text in enumerate(batch, 1):
                some.append(words_of(text))
                size += len(some[-1])
                if size >= AT_ONCE or place == len(batch):
                    of, *columns = anchors.find(some)
                    found.append(columns)
                    counts.append(np.bincount(of, minlength=len(some)))
                    some, size = [], 0
            ends = np.concatenate([[0], *counts]).cumsum().astype(np.int32)
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], fields=list(kind))
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)

        return step

    return text_udf(start, "array<struct<h:long,low:int,n:int>>")(text)


def routed_anchors(named: DataFrame, window: int) -> DataFrame:
    """Per text its repeated anchors: their windows, whether it is the first one, shard, slices of the shard and own slice."""
    found = materialize(named.where("doc IS NOT NULL").select("doc", "tie", F.inline(anchors_of(F.col("text"), window))), "anchors")
    firsts = materialize(
        found.groupBy("h").agg(F.count("*").alias("times"), F.min(F.struct("doc", "low")).alias("first")).where("times > 1").select("h", "first"), "first_anchors")
    shards = max(1, -(-firsts.count() * GRAM // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("first.doc", F.shiftright("first.low", PIECE_BITS)), F.lit(shards)).cast("int")
    # Anchors that many documents share are skewed keys on the left, which AQE splits: the other side is a plain table.
    is_first = (F.col("doc") == F.col("first.doc")) & (F.col("low") == F.col("first.low"))
    located = materialize(found.join(firsts, "h").select("doc", "tie", "low", "n", is_first.alias("is_first"), shard.alias("shard")), "repeated_anchors")
    # A plain table of the few crowded shards, so that the anchors need not be dealt by shard to meet it.
    asked = located.groupBy("shard").agg(F.count("*").alias("anchors")).select("shard", F.ceil(F.col("anchors") / SLICE_ANCHORS).cast("int").alias("slices")).where("slices > 1")
    dealt = located.join(materialize(asked, "crowded_shards"), "shard", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.pmod(F.xxhash64("doc", F.shiftright("low", PIECE_BITS)), F.col("slices")).cast("int")
    # References go to all slices of their shard, so their own one says nothing.
    slice_ = F.when(F.col("is_first"), 0).otherwise(own)
    return dealt.groupBy("doc", "tie").agg(F.collect_list(F.struct("low", "n", "is_first", "shard", "slices", slice_.alias("slice"))).alias("anchors"))


def passages(named: DataFrame, anchors: DataFrame, window: int) -> DataFrame:
    """(shard, slice, is_first, doc, tie, start, words): references, once for each slice, and passages to be streamed against them."""
    joined = named.join(anchors, ["doc", "tie"])
    names = ["shard", "slices", "slice", "is_first"]

    @F.arrow_udf("array<struct<shard:int,slices:int,slice:int,is_first:boolean,start:int,words:binary>>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            flat = lists.flatten()
            low, n, *keys = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("low", "n", *names))
            borders = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            columns, starts, words, ends = [[] for _ in names], [], [], [0]
            for text, a, b in zip(strings(texts), borders[:-1].tolist(), borders[1:].tolist()):
                # A row that repeats another one has its anchors twice.
                begin, order = np.unique(low[a:b], return_index=True)
                order += a
                end = begin + n[order]
                new = begin[1:] != end[:-1]
                for key in keys:
                    new |= key[order][1:] != key[order][:-1]
                heads = np.flatnonzero(np.concatenate([[True], new]))
                tails = np.append(heads[1:], len(order)) - 1
                all_words = words_of(text)
                starts.append(begin[heads])
                words += [b" ".join(all_words[i : j + window - 1]) for i, j in zip(begin[heads].tolist(), end[tails].tolist())]
                for column, key in zip(columns, keys):
                    column.append(key[order[heads]])
                ends.append(len(words))
            shard, slices, slice_, is_first = (np.concatenate([np.zeros(0, np.int64), *c]) for c in columns)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([
                *[pa.array(x, pa.int32()) for x in (shard, slices, slice_)], pa.array(is_first.astype(bool)),
                pa.array(np.concatenate([np.zeros(0, np.int64), *starts]), pa.int32()), pa.array(words, pa.binary())], [*names, "start", "words"]))

    found = joined.select("doc", "tie", F.inline(cut("text", "anchors")))
    slices = F.when(F.col("is_first"), F.sequence(F.lit(0), F.col("slices") - 1)).otherwise(F.array("slice"))
    return found.select("shard", F.explode(slices).alias("slice"), "is_first", "doc", "tie", "start", "words")


def matched_windows(cut: DataFrame, window: int) -> DataFrame:
    """(doc, tie, low, high, digest): windows low to high occur earlier; with a digest, one window for which no earlier place was found."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out = cut.select("doc", "tie", F.col("start").alias("low"), F.col("start").alias("high"), F.col("words").alias("digest"))
    schema = to_arrow_schema(out.schema, prefers_large_types=False)

    def stream(references: pa.Table, asked: pa.Table) -> pa.Table:
        lines: list[tuple] = []
        if asked.num_rows:
            known = {(r["doc"], r["start"], r["words"]) for r in references.select(["doc", "start", "words"]).to_pylist()}
            automaton = Automaton((doc, start, words.split()) for doc, start, words in sorted(known))
            for r in asked.select(["doc", "tie", "start", "words"]).to_pylist():
                words, doc, low = r["words"].split(), r["doc"], None
                for i, (matched, first) in enumerate(automaton.matches(words, window)):
                    if i < window - 1:
                        continue
                    here = r["start"] + i - window + 1
                    if matched >= window and first < (doc, r["start"] + i):
                        low = here if low is None else low
                        continue
                    if low is not None:
                        lines.append((doc, r["tie"], low, here - 1, None))
                        low = None
                    digest = hashlib.blake2b(b" ".join(words[i - window + 1 : i + 1]), digest_size=16).digest()
                    lines.append((doc, r["tie"], here, here, digest))
                if low is not None:
                    lines.append((doc, r["tie"], low, r["start"] + len(words) - window, None))
        return pa.Table.from_arrays([pa.array([x[i] for x in lines], f.type) for i, f in enumerate(schema)], schema=schema)

    keys = ("shard", "slice")
    return cut.where("is_first").groupBy(*keys).cogroup(cut.where("NOT is_first").groupBy(*keys)).applyInArrow(stream, out.schema)


def repeats(named: DataFrame, window: int) -> DataFrame:
    """(doc, tie, ranges): the windows of each text that occur earlier, as ranges of their first words."""
    cut = materialize(passages(named, routed_anchors(named, window), window), "passages")
    found = materialize(matched_windows(cut, window), "matched_windows")
    rest = found.where("digest IS NOT NULL")
    firsts = rest.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("doc", "low")).alias("first")).where("n > 1")
    later = rest.join(firsts, "digest").where(F.struct("doc", "low") > F.col("first"))
    every = found.where("digest IS NULL").select("doc", "tie", "low", "high").unionByName(later.select("doc", "tie", "low", "high"))
    return every.groupBy("doc", "tie").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))


def kept_words(text: Column, ranges: Column, window: int) -> Column:
    """Struct of n_words, n_removed, kept (the words that stay, joined by blanks) and spans (first and last removed word of each run)."""
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("spans", pa.list_(pa.list_(pa.int32())))])

    def one(text: str, ranges: list[dict] | None) -> dict:
        words = words_of(text)
        if not ranges:
            return {"n_words": len(words), "n_removed": 0, "kept": b" ".join(words).decode(), "spans": []}
        change = np.zeros(len(words) + 1, np.int64)
        for r in ranges:
            change[r["low"]] += 1
            change[r["high"] + window] -= 1
        gone = np.cumsum(change)[:-1] > 0
        edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        kept = b" ".join([word for word, out in zip(words, gone.tolist()) if not out])
        return {"n_words": len(words), "n_removed": int(gone.sum()), "kept": kept.decode(), "spans": [[int(a), int(b) - 1] for a, b in edges]}

    @F.arrow_udf("n_words long, n_removed long, kept string, spans array<array<int>>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            yield pa.array([one(t, r) for t, r in zip(strings(texts), lists.to_pylist())], kind)

    return run(text, ranges)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: identifier, n_words, n_removed, kept text and spans of removed words."""
    named = docs.select(F.col(f"`{id_col}`").alias("doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).withColumn("tie", F.hash("text"))
    found = repeats(named, window).select(F.col("doc").alias("_doc"), F.col("tie").alias("_tie"), "ranges")
    joined = named.join(found, (F.col("doc") == F.col("_doc")) & (F.col("tie") == F.col("_tie")), "left")
    return joined.select(F.col("doc").alias(id_col), kept_words(F.col("text"), F.col("ranges"), window).alias("found")).select(id_col, "found.*")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    found = without_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS MATERIALIZED (SELECT doc_id, s, array_to_string(words[s:s + 19], ' ') AS window_text FROM d, range(1, len(words) - 18) AS g(s)),
later AS (SELECT doc_id, s FROM w QUALIFY row_number() OVER (PARTITION BY window_text ORDER BY doc_id, s) > 1),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, s + k AS place FROM later, range(0, 20) AS g(k)),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
each AS (SELECT doc_id, words[place] AS word, place FROM d, range(1, len(words) + 1) AS g(place)),
stay AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept FROM each ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN stay USING (doc_id)
"""

cloudpickle.register_pickle_by_value(sys.modules[__name__])
