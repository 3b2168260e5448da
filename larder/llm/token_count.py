"""Token counts of a byte-level BPE vocabulary, without building identifiers.

A text is cut at the vocabulary's special strings and by its pattern into pieces. The symbols of a piece form a linked
list; a heap holds the mergeable neighbours. The pair of lowest rank is popped and merged until none is left: the count
is the number of bytes less the number of merges. Pieces repeat, so a worker remembers the counts of short ones (bounded).

Defined results: null and empty texts have 0 bytes and 0 tokens; null identifiers and repeated rows are passed on; an
empty table gives an empty result; a text of any length is counted whole, with memory bounded by its longest piece.
"""

from __future__ import annotations

import itertools
import json
import sys
from collections import Counter
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import table, text_udf

#: Fixed value: the pattern of byte-level pre-tokenisation.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LIMIT = 512
# Bounds per worker: remembered pieces, the length of a remembered piece, pieces taken from a text at once.
CACHE_PIECES, CACHE_BYTES, AT_ONCE = 600_000, 64, 100_000
LARGEST_MODEL = 64_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counts:
    """Counts the tokens of texts with a model of ``read_model``."""

    def __init__(self, model: dict, pattern: str = PATTERN):
        import regex

        self.rank, self.merged, self.known = model["rank"], model["merged"], model["known"]
        self.pieces = regex.compile(pattern)
        specials = sorted(model["specials"], key=len, reverse=True)
        self.special = regex.compile("|".join(regex.escape(s) for s in specials)) if specials else None

    def piece(self, piece: str) -> int:
        symbols = list(piece.encode("utf-8", "replace"))
        n, rank, merged = len(symbols), self.rank, self.merged
        # Heap entries are rank and place of the left symbol in one number, so ties go to the leftmost pair.
        heap = [r << 32 | i for i, (a, b) in enumerate(itertools.pairwise(symbols)) if (r := rank.get(a << 17 | b)) is not None]
        if not heap:
            return n
        heap.sort()
        after, before, end, count = list(range(1, n + 1)), list(range(-1, n - 1)), n, n
        while heap:
            entry = heappop(heap)
            i, r = entry & 0xFFFFFFFF, entry >> 32
            j = after[i]
            if j == end or symbols[j] < 0 or rank.get(symbols[i] << 17 | symbols[j]) != r:
                continue  # one of the two was merged away meanwhile
            count -= 1
            symbols[i] = symbol = merged[r]
            symbols[j] = -1
            after[i] = k = after[j]
            after[j] = end
            if k != end:
                before[k] = i
                r = rank.get(symbol << 17 | symbols[k])
                if r is not None:
                    heappush(heap, r << 32 | i)
            h = before[i]
            if h >= 0:
                r = rank.get(symbols[h] << 17 | symbol)
                if r is not None:
                    heappush(heap, r << 32 | h)
        return count

    def _sum(self, pieces: list[str]) -> int:
        known, total = self.known, 0
        for piece, times in Counter(pieces).items():
            count = known.get(piece)
            if count is None:
                count = self.piece(piece)
                if len(piece) <= CACHE_BYTES:
                    if len(known) >= CACHE_PIECES:
                        known.clear()
                    known[piece] = count
            total += count * times
        return total

    def plain(self, text: str) -> int:
        if len(text) <= AT_ONCE:
            return self._sum(self.pieces.findall(text))
        found = (m.group() for m in self.pieces.finditer(text))
        total = 0
        while some := list(itertools.islice(found, AT_ONCE)):
            total += self._sum(some)
        return total

    def text(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        specials = sum(1 for _ in self.special.finditer(text))
        return specials + sum(self.plain(part) for part in self.special.split(text) if part)


def read_model(path: str) -> dict:
    """Ranks, merged symbols and special strings of a tokenizer file, read on the driver. Its size is checked, so that it may be sent to all tasks.

    Pairs of symbols are one number: left << 17 | right. ``known`` is the memory of counts, which each worker fills for itself.
    """
    with open(path, "rb") as file:
        raw = file.read(LARGEST_MODEL + 1)
    if len(raw) > LARGEST_MODEL:
        raise ValueError(f"{path} has more than {LARGEST_MODEL} bytes")
    file, letters = json.loads(raw), byte_letters()
    number = {bytes([b]): b for b in range(256)}
    rank: dict[int, int] = {}
    merged: list[int] = []
    for merge in file["model"]["merges"]:
        left, right = (bytes(letters[c] for c in part) for part in (merge.split(" ") if isinstance(merge, str) else merge))
        rank[number[left] << 17 | number[right]] = len(merged)
        merged.append(number.setdefault(left + right, len(number)))
    if len(number) > 1 << 17:
        raise ValueError(f"{path} has more than {1 << 17} symbols")
    return {"rank": rank, "merged": merged, "specials": [t["content"] for t in file["added_tokens"]], "known": {}}


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """Per document: id, n_bytes, n_tokens and whether n_tokens is over ``limit``."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def start():
        counts = Counts(model.value)
        return lambda batch: pa.array([counts.text(t) for t in batch], pa.int64())

    counted = docs.select(
        F.col(id_col), F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"),
        text_udf(start, "long")(F.col(text_col)).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
