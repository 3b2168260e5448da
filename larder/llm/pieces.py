"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie of scored pieces.

Encoding: a space is put before the text and spaces become the marker U+2581; at each character the trie gives every piece that
starts there; the best path is the one of highest total score, ties going to the one found first. A character without
piece costs ``UNKNOWN_PENALTY`` less than the lowest score and is written as its UTF-8 bytes' pieces (or as the unknown
piece where the model has none). The best path never crosses a place that no piece crosses. So the text is cut before markers,
where no piece holds one behind another character; and between characters that no piece holds together, directly or through
others: letters and full stops, say, or letters and line breaks. A worker remembers the paths of short cuts in two generations: when the young one is full it becomes the old
one, whose cuts move back when they are met again, so that frequent cuts stay and memory is bounded.

Decoding: pieces are joined, runs of byte pieces become characters (replacement marks where they are no UTF-8), markers
become spaces and the first space goes.

Defined results: null and empty texts have no pieces and decode to the empty text; a marker in a text decodes to a
space; identifiers outside the vocabulary decode to nothing; null identifiers and repeated rows are passed on; an empty
table gives an empty result. Texts are encoded whole. The model must not rewrite characters (identity normaliser).
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import table, text_udf

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_CUTS, CACHE_CHARS = 200_000, 64
LARGEST_MODEL = 64_000_000


def double_array(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value of the double-array trie of ``keys``; value is the key's place in the list, or -1.

    The child of node s by byte c is base[s] + c, if check there is s.
    """
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for place, key in enumerate(keys):
        node = 0
        for c in key:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][c]
        ends[node] = place
    size = 2 * len(children) + 1024
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    taken = bytearray(size)
    taken[0] = 1
    # A search begins where the last long one ended, for single children and for several.
    slot, front = {0: 0}, [1, 1]
    queue = [0]
    for node in queue:
        at = slot[node]
        value[at] = ends[node]
        labels = sorted(children[node])
        if not labels:
            continue
        several = len(labels) > 1
        b = begin = max(1, front[several] - labels[0])
        while any(taken[b + c] for c in labels):
            b += 1
            if b + 512 > len(taken):
                taken.extend(bytes(len(taken)))
                base, check, value = (np.concatenate([a, np.full(len(a), fill, np.int32)]) for a, fill in ((base, 0), (check, -1), (value, -1)))
        if b - begin > 32:
            front[several] = b + labels[0]
        base[at] = b
        for c in labels:
            taken[b + c] = 1
            check[b + c] = at
            slot[children[node][c]] = b + c
            queue.append(children[node][c])
    return base, check, value


def joined_characters(pieces: list[str]) -> list[str]:
    """Classes of characters, markers left out: those that some piece holds together, directly or through others. The largest first."""
    of: dict[str, set[str]] = {}
    for piece in pieces:
        chars = set(piece) - {MARK}
        if len(chars) > 1:
            joined = set().union(chars, *(of[c] for c in chars if c in of))
            if any(of.get(c) is not of.get(piece[-1]) or c not in of for c in chars):
                of |= dict.fromkeys(joined, joined)
        elif chars and len(piece) > 1:
            of.setdefault(*chars, chars)
    return ["".join(sorted(c)) for c in sorted({id(c): c for c in of.values()}.values(), key=len, reverse=True)]


def read_model(path: str) -> dict:
    """Pieces, scores and trie of a model file as plain values, read on the driver. Its size is checked, so that it may be sent to all tasks."""
    from sentencepiece import sentencepiece_model_pb2 as formats

    with open(path, "rb") as file:
        raw = file.read(LARGEST_MODEL + 1)
    if len(raw) > LARGEST_MODEL:
        raise ValueError(f"{path} has more than {LARGEST_MODEL} bytes")
    proto = formats.ModelProto()
    proto.ParseFromString(raw)
    spec = proto.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces:
        raise ValueError(f"{path} rewrites texts before encoding")
    kinds = formats.ModelProto.SentencePiece
    words = [(i, p.piece, p.score) for i, p in enumerate(proto.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]
    base, check, value = double_array([w.encode() for _, w, _ in words])
    return {
        "base": base.tolist(), "check": check.tolist(), "value": value.tolist(),
        "ids": [i for i, _, _ in words], "scores": [s for _, _, s in words],
        "pieces": {i: w for i, w, _ in words},
        "bytes": {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE},
        "unknown": next((i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN), 0),
        "cuts": not any(re.search(f"[^{MARK}]{MARK}", w) for _, w, _ in words),
        "classes": joined_characters([w for _, w, _ in words]),
        "known": {},
    }


class Encoder:
    def __init__(self, model: dict):
        self.m = model
        self.base, self.check, self.value = model["base"], model["check"], model["value"]
        self.lowest = min(model["scores"], default=0.0) - UNKNOWN_PENALTY
        # A marker starts a cut; where pieces hold one elsewhere, texts stay whole.
        self.cut = re.compile("(?s).+")
        if model["cuts"]:
            classes = [f"[{re.escape(c)}]+" for c in model["classes"]]
            others = f"[^{re.escape(''.join(model['classes']))}{MARK}]+"
            self.cut = re.compile(f"{MARK}*(?:{'|'.join([*classes, others])})|{MARK}+")

    def best(self, text: str) -> bytes:
        """Identifiers of the best path through ``text`` (markers in place), as 32-bit numbers."""
        raw = text.encode("utf-8", "replace")
        n, base, check, value, scores = len(raw), self.base, self.check, self.value, self.m["scores"]
        size = len(check)
        nowhere = float("-inf")
        total, came, piece = [nowhere] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        total[0] = 0.0
        for i in range(n):
            so_far = total[i]
            if so_far == nowhere:
                continue
            step = 1 if raw[i] < 0x80 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
            single, node, j = False, 0, i
            while j < n:
                child = base[node] + raw[j]
                if child >= size or check[child] != node:
                    break
                node, j = child, j + 1
                word = value[node]
                if word >= 0:
                    single = single or j == i + step
                    reached = so_far + scores[word]
                    if reached > total[j]:
                        total[j], came[j], piece[j] = reached, i, word
            if not single:
                j, reached = i + step, so_far + self.lowest
                if reached > total[j]:
                    total[j], came[j], piece[j] = reached, i, -1
        back, j = [], n
        while j > 0:
            i = came[j]
            if piece[j] >= 0:
                back.append(self.m["ids"][piece[j]])
            elif self.m["bytes"]:
                back.extend(self.m["bytes"][b] for b in reversed(raw[i:j]))
            else:
                back.append(self.m["unknown"])
            j = i
        return array("i", reversed(back)).tobytes()

    def text(self, text: str, out: array) -> None:
        """Appends the identifiers of ``text`` to ``out``."""
        if not text:
            return
        # The two generations of remembered paths.
        known = self.m["known"]
        young, old = known.setdefault("young", {}), known.setdefault("old", {})
        for cut in self.cut.findall(MARK + text.replace(" ", MARK)):
            ids = young.get(cut)
            if ids is None:
                ids = old.get(cut)
                if ids is None:
                    ids = self.best(cut)
                if len(cut) <= CACHE_CHARS:
                    if len(young) >= CACHE_CUTS:
                        young, old = {}, young
                        known.update(young=young, old=old)
                    young[cut] = ids
            out.frombytes(ids)


class Decoder:
    def __init__(self, model: dict):
        self.high = {i: b for b, i in model["bytes"].items() if b >= 0x80}
        self.text_of = {i: w.replace(MARK, " ") for i, w in model["pieces"].items()} | {i: chr(b) for b, i in model["bytes"].items() if b < 0x80}
        self.text_of[model["unknown"]] = " ⁇ "
        self.spaced = {i for i, w in model["pieces"].items() if w.startswith(MARK)}
        self.stray = re.compile("[\udc80-\udcff]")

    def ids(self, ids: list[int]) -> str:
        text_of, high, parts, run = self.text_of, self.high, [], bytearray()
        if high.keys().isdisjoint(ids):
            parts = [text_of.get(i, "") for i in ids]
        else:
            for i in [*ids, None]:
                if i in high:
                    run.append(high[i])
                    continue
                if run:
                    # One replacement mark for each byte that is no UTF-8.
                    parts.append(self.stray.sub("\ufffd", run.decode("utf-8", "surrogateescape")))
                    run.clear()
                parts.append(text_of.get(i, ""))
        return "".join(parts)[1 if ids and ids[0] in self.spaced else 0 :]


def encoded(text: Column, model: dict, spark: SparkSession) -> Column:
    """Piece identifiers of a text column."""
    sent = spark.sparkContext.broadcast(model)

    def start():
        encoder = Encoder(sent.value)

        def step(batch: list[str]) -> pa.Array:
            flat, ends = array("i"), [0]
            for t in batch:
                encoder.text(t, flat)
                ends.append(len(flat))
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))

        return step

    return text_udf(start, "array<int>")(text)


def decoded(ids: Column, model: dict, spark: SparkSession) -> Column:
    """Text of a column of piece identifiers; null counts as none."""
    sent = spark.sparkContext.broadcast(model)

    def start():
        decoder = Decoder(sent.value)
        return lambda batch: pa.array([decoder.ids(ids or []) for ids in batch], pa.string())

    return text_udf(start, "string")(ids)


def encoded_and_decoded(text: Column, model: dict, spark: SparkSession) -> Column:
    """Struct of a text column: its pieces, and round_trip: whether decoding them gives the text back."""
    sent = spark.sparkContext.broadcast(model)

    def start():
        encoder, decoder = Encoder(sent.value), Decoder(sent.value)

        def step(batch: list[str]) -> pa.Array:
            flat, ends, same = array("i"), [0], []
            for t in batch:
                encoder.text(t, flat)
                same.append(decoder.ids(flat[ends[-1] :]) == t)
                ends.append(len(flat))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))
            return pa.StructArray.from_arrays([lists, pa.array(same, pa.bool_())], ["pieces", "round_trip"])

        return step

    return text_udf(start, "pieces array<int>, round_trip boolean")(text)


def checked(text: Column, model: dict, spark: SparkSession) -> Column:
    """Struct of a text column: n_pieces, n_distinct, pieces_sha256 (of the identifiers as 32-bit numbers) and round_trip.

    Encodes and decodes each text at once, for uses that need no identifiers: those of one text are held at a time.
    """
    sent = spark.sparkContext.broadcast(model)
    kind = pa.struct([("n_pieces", pa.int64()), ("n_distinct", pa.int64()), ("pieces_sha256", pa.string()), ("round_trip", pa.bool_())])

    def start():
        encoder, decoder = Encoder(sent.value), Decoder(sent.value)

        def one(text: str) -> dict:
            ids = array("i")
            encoder.text(text, ids)
            return {"n_pieces": len(ids), "n_distinct": len(set(ids)), "pieces_sha256": hashlib.sha256(ids.tobytes()).hexdigest(),
                    "round_trip": decoder.ids(ids) == text}

        return lambda batch: pa.array([one(t) for t in batch], kind)

    return text_udf(start, "n_pieces long, n_distinct long, pieces_sha256 string, round_trip boolean")(text)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: n_pieces, n_distinct of them, a digest of their sequence, and whether decoding gives the text back."""
    import public_tokenizers

    model = read_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", checked(F.col("text"), model, spark).alias("found")).select("doc_id", "found.*")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
