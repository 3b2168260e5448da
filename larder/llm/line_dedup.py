"""Near-duplicate lines by a segment-partition edit join.

Two lines are linked when few insertions, deletions and substitutions of characters turn one into the other: at most
``EDITS``, or one where the shorter line has less than ``LEAST_CHARS`` characters.
A line is cut into one segment more than its edits, so a line linked with it holds one of them unchanged, near its old place. The index
has the hash of each segment with the line's length and the segment's number. A line probes, for its own and each smaller
length within reach, the substrings at the places where a segment can have gone (the multi-match-aware selection), so each
link is found from its longer line. Candidates are verified by bit-parallel edit distance on the band of 2 EDITS + 1
diagonals. Links are closed to classes; the first line of a class by (document, line number) is kept.

A bucket (all lines that hold one segment) is never paired row by row: all members are verified against its smallest
one first. Where it still holds several classes, a bucket of at most ``CROWDED`` lines is compared in blocks of ``BLOCK``, each pair
of blocks inside a task, pairs of one class excepted. A larger one is split by the same partition of what its lines hold beside the segment: two lines within reach
share a segment of that too, at the places where the edits allow it, so lines that have only a common start or end never
meet. This goes on until buckets are small or nothing is left to cut; only lines that agree in all but ``EDITS`` characters
are then still compared block by block. Repeated lines are sent once per task, not once per copy.

Defined results: blank lines are always kept and have no class; lines under ``SHORT_CHARS`` characters are duplicates only of equal
lines, as an edit makes another line of them; null and empty texts have no lines; documents without identifier come
last in order; rows that repeat an identifier and text are one document; an empty table gives an empty result. Lines of any
length are compared whole.
"""

from __future__ import annotations

import functools
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import packed, small_batches, strings, table, unpacked
from larder.llm.components import components
from larder.session import materialize

EDITS = 2
LEAST_CHARS = 24
SHORT_EDITS, SHORT_CHARS = 1, 12
BLOCK = 256
# Buckets beyond this are split; up to it, comparing all pairs is less work than another round of jobs.
CROWDED = 1024
SEEN = 500_000
# The largest filter of line hashes that tasks get: 8 MB.
FILTER_BITS = 1 << 26


def partition(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of nearly even segments, the longer ones last."""
    size, longer = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        width = size + (i >= parts - longer)
        out.append((at, width))
        at += width
    return out


# Places by lengths and edits, so that they are worked out once per task.
_PLACES: dict[tuple[int, int, int], list[tuple[int, int, int]]] = {}


def places(size: int, length: int, edits: int) -> list[tuple[int, int, int]]:
    """(segment number, place, width) where a text of ``size`` characters can hold the segments of one of ``length``."""
    known = _PLACES.get((size, length, edits))
    if known is None:
        if len(_PLACES) >= 50_000:
            _PLACES.clear()
        known = _PLACES[size, length, edits] = []
        more = size - length
        for i, (p, w) in enumerate(partition(length, edits + 1)):
            # At most i edits lie before segment i (from 0), at most edits - i behind it.
            first = max(p - i, p + more - (edits - i), 0)
            last = min(p + i, p + more + (edits - i), size - w)
            known += [(i, q, w) for q in range(first, last + 1)]
    return known


def edits_of(length: int) -> int:
    """The edits that link a line of that length with one at least as long."""
    return EDITS if length >= LEAST_CHARS else SHORT_EDITS if length >= SHORT_CHARS else 0


def index_keys(line: str) -> list[tuple[int, int, str]]:
    """(length, segment number, segment) of a line."""
    return [(len(line), i, line[p : p + w]) for i, (p, w) in enumerate(partition(len(line), edits_of(len(line)) + 1))]


def probe_keys(line: str) -> list[tuple[int, int, str]]:
    """The index keys that a line at most as long and within its edits can share with ``line``."""
    out = []
    for shorter in range(EDITS + 1):
        length = len(line) - shorter
        edits = edits_of(length)
        if length < SHORT_CHARS or shorter > edits:
            break
        out += [(length, i, line[q : q + w]) for i, q, w in places(len(line), length, edits)]
    return out


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether the edit distance is at most ``edits``: one bit per diagonal and number of edits, one step per character."""
    if abs(len(a) - len(b)) > edits:
        return False
    if a == b:
        return True
    start, stop = 0, min(len(a), len(b))
    while start < stop and a[start] == b[start]:
        start += 1
    a, b = a[start:], b[start:]
    tail, stop = 0, min(len(a), len(b))
    while tail < stop and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not a or not b:
        return True
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    # Bit k + i - j of alive[d]: the first i characters of a become the first j of b with at most d edits.
    k, band = edits, (1 << 2 * edits + 1) - 1
    alive = [((1 << d + 1) - 1) << k & band for d in range(k + 1)]
    for j, c in enumerate(b):
        places = where.get(c, 0)
        match = (places >> j - k if j >= k else places << k - j) & band
        inside = band
        if j + 1 < k:
            inside &= band << k - j - 1  # no place before the start of a
        room = len(a) - (j + 1) + k
        if room < 2 * k:
            inside &= (1 << max(room + 1, 0)) - 1  # none behind its end
        before = alive[0]
        alive[0] = before & match & inside
        for d in range(1, k + 1):
            here = alive[d]
            alive[d] = (here & match | before | before >> 1 | alive[d - 1] << 1) & inside
            before = here
        if not alive[k]:
            return False
    return bool(alive[k] >> k + len(a) - len(b) & 1)


def linked(a: str, b: str) -> bool:
    """Whether two different lines are near enough for the length of the shorter one."""
    edits = edits_of(min(len(a), len(b)))
    return edits > 0 and within(a, b, edits)


def _lines(docs: DataFrame) -> DataFrame:
    """(id, text_key, line_no, key, line) of all lines that are not blank. key is the MD5 of the line."""
    split = docs.select("id", F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return split.where(F.trim("line") != "").withColumn("key", F.unhex(F.md5(F.col("line").cast("binary"))))


def _keys(docs: DataFrame, keys_of) -> DataFrame:
    """(h, id): hashed keys of each line, once per task."""
    small_batches(docs.sparkSession)

    def run(batches):
        import xxhash

        seen: set[int] = set()
        for batch in batches:
            hashes, ids = [], []
            for text in strings(batch.column("text")):
                for line in text.split("\n"):
                    if len(line) < SHORT_CHARS or not line.strip(" "):
                        continue
                    number = xxhash.xxh3_64_intdigest(line.encode("utf-8", "replace"))
                    if number in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(number)
                    for length, i, part in keys_of(line):
                        hashes.append(xxhash.xxh3_64_intdigest(part.encode("utf-8", "replace"), length * 8 + i))
                        ids.append(number)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.uint64).view(np.int64)) for c in (hashes, ids)], ["h", "id"])

    return docs.select("text").mapInArrow(run, "h long, id long")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, key, line) of the lines with the given hashes, once each.

    A bitmap of the hashes, of at most ``FILTER_BITS`` bits, keeps most other lines out of the exchange; those that it
    lets through the join leaves out.
    """
    bits = min(FILTER_BITS, max(1 << 16, 1 << (16 * ids.count()).bit_length()))
    places = ids.select(F.pmod("id", F.lit(bits)).alias("place"))
    words = places.selectExpr("shiftright(place, 5) AS word", "shiftleft(1L, CAST(place % 32 AS INT)) AS bit").groupBy("word").agg(F.bit_or("bit").alias("set")).toArrow()
    bitmap = np.zeros(bits >> 5, np.uint32)
    bitmap[words["word"].to_numpy()] = words["set"].to_numpy().astype(np.uint32)
    sent = docs.sparkSession.sparkContext.broadcast(bitmap.tobytes())

    def run(batches):
        import hashlib

        import xxhash

        wanted = np.frombuffer(sent.value, np.uint32)
        seen: set[int] = set()
        for batch in batches:
            out = ([], [], [])
            for text in strings(batch.column("text")):
                for line in text.split("\n"):
                    if len(line) < SHORT_CHARS or not line.strip(" "):
                        continue
                    raw = line.encode("utf-8", "replace")
                    number = xxhash.xxh3_64_intdigest(raw)
                    at = number % bits
                    if number in seen or not int(wanted[at >> 5]) >> (at & 31) & 1:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(number)
                    for column, value in zip(out, (number, hashlib.md5(raw).digest(), line)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(out[0], np.uint64).view(np.int64)), pa.array(out[1], pa.binary()), pa.array(out[2], pa.string())], ["id", "key", "line"])

    lines = docs.select("text").mapInArrow(run, "id long, key binary, line string")
    return lines.join(ids, "id", "left_semi").dropDuplicates(["id", "key"])


def _verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Links (a, b) between the keys of the lines of (left, right) whose edit distance is small enough."""

    one = lines.select(F.col("id").alias("left"), F.col("key").alias("a"), F.col("line").alias("x"))
    other = lines.select(F.col("id").alias("right"), F.col("key").alias("b"), F.col("line").alias("y"))
    return _checked(pairs.join(one, "left").join(other, "right").select("a", "b", "x", "y"))


def _across(members: DataFrame) -> DataFrame:
    """Links between different classes of one bucket, found block by block."""
    sizes = members.groupBy("h").agg(F.count("*").alias("size"))
    block = F.when(F.col("size") <= BLOCK, 0).otherwise(F.pmod(F.xxhash64("key"), F.ceil(2 * F.col("size") / BLOCK))).cast("int")
    blocks = members.join(sizes, "h").groupBy("h", block.alias("block")).agg(F.collect_list(F.struct("key", "label", "line")).alias("members"))
    blocks = materialize(blocks, "line_blocks")
    pairs = blocks.withColumnRenamed("members", "left").join(
        blocks.withColumnsRenamed({"members": "right", "block": "other"}), "h").where("block <= other")
    # Few bytes may be much work: pairs of blocks are dealt to a fixed number of tasks, which are not put together by their size.
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(tasks, "h", "block", "other").select("left", "right")

    def run(batches):
        for batch in batches:
            out = ([], [])
            for line in range(batch.num_rows):
                left, right = (batch.column(c)[line].as_py() for c in ("left", "right"))
                merged: dict[bytes, bytes] = {}

                def root(label):
                    while label in merged:
                        label = merged[label]
                    return label

                for x in left:
                    for y in right:
                        if x["label"] == y["label"] or abs(len(x["line"]) - len(y["line"])) > EDITS:
                            continue
                        # Classes that a link of these blocks has joined need no second one.
                        p, q = root(x["label"]), root(y["label"])
                        if p != q and linked(x["line"], y["line"]):
                            merged[p] = q
                            out[0].append(x["key"])
                            out[1].append(y["key"])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in out], ["a", "b"])

    return pairs.mapInArrow(run, "a binary, b binary")


def _cut(rows: DataFrame) -> DataFrame:
    """The buckets of the next level: the segments of each remainder, and what is left without them.

    Rows are (h, key, label, line, rest, length, edits, indexed): the bucket's hash, the line, its remainder and the length of
    the remainders on the indexed side of the bucket, which hold their own segments; others probe.
    """

    def run(batches):
        import xxhash

        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                out = tuple([] for _ in batch.schema)
                for row in batch.slice(start, 1024).to_pylist():
                    rest, length, edits = row["rest"], row["length"], row["edits"]
                    if row["indexed"]:
                        found = [(i, p, w) for i, (p, w) in enumerate(partition(length, edits + 1))]
                    else:
                        found = places(len(rest), length, edits)
                    # Equal segments at neighbouring places of one text leave the same remainder.
                    for i, part, left, w in dict.fromkeys((i, rest[q : q + w], rest[:q] + rest[q + w :], w) for i, q, w in found):
                        number = xxhash.xxh3_64_intdigest(part.encode("utf-8", "replace"), row["h"] * 8 + i & (1 << 64) - 1)
                        line = (number - (number >> 63 << 64), row["key"], row["label"], row["line"], left, length - w, edits, row["indexed"])
                        for column, value in zip(out, line):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, batch.schema)], schema=batch.schema)

    return rows.mapInArrow(run, rows.schema)


def _uncut(lines: DataFrame) -> DataFrame:
    """Each line of (key, label, line) as its own remainder: indexed, and probing for each length within reach.

    Their first ``_cut`` gives the hashes of ``_keys``.
    """
    size = F.char_length("line")

    def edits(length):
        return F.when(length >= LEAST_CHARS, EDITS).when(length >= SHORT_CHARS, SHORT_EDITS).otherwise(0)

    def side(shorter, indexed):
        length = size - shorter
        row = F.struct(length.cast("long").alias("h"), F.col("line").alias("rest"), length.alias("length"), edits(length).alias("edits"), F.lit(indexed).alias("indexed"))
        return F.when((edits(length) > 0) & (edits(length) >= shorter), row)

    sides = F.array_compact(F.array(side(0, True), *[side(n, False) for n in range(EDITS + 1)]))
    found = lines.select("key", "label", "line", F.inline(sides))
    return found.select("h", "key", "label", "line", "rest", "length", "edits", "indexed")


def _checked(pairs: DataFrame) -> DataFrame:
    """The links (a, b) among (a, b, x, y), lines x and y of keys a and b."""

    def run(batches):
        for batch in batches:
            keep = [linked(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(run, "a binary, b binary")


def _crowded(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """Links between different classes of buckets that hold more than ``CROWDED`` lines, by splitting them."""
    lines = members.join(buckets, "h", "left_semi").select("key", "label", "line").distinct()
    rows = materialize(_cut(_uncut(lines)).join(buckets, "h", "left_semi"), "crowded_lines")
    links = []
    while not rows.isEmpty():
        # Nothing can be cut from remainders that have no more characters than edits.
        uncut = rows.where("length <= edits").select("h", "key", "label", "line").distinct()
        if not uncut.isEmpty():
            links.append(_across(uncut))
        rows = materialize(_cut(rows.where("length > edits")), "crowded_lines")
        lead = F.min(F.when(F.col("indexed"), F.struct("key", "label", "line")))
        leads = rows.groupBy("h").agg(lead.alias("lead"), F.min("label").alias("low"), F.max("label").alias("high"), F.min("indexed").alias("all_indexed"))
        leads = leads.where("low <> high AND lead IS NOT NULL AND NOT all_indexed").select("h", "lead")
        met = materialize(rows.join(leads, "h"), "crowded_lines")
        stars = met.where("label <> lead.label").select(F.col("key").alias("a"), F.col("lead.key").alias("b"), F.col("line").alias("x"), F.col("lead.line").alias("y"), "label", F.col("lead.label").alias("other"))
        stars = stars.dropDuplicates(["a", "b"])
        found = materialize(_checked(stars.select("a", "b", "x", "y")).join(stars.select("a", "b", "label", "other"), ["a", "b"]), "line_links")
        links.append(found.select("a", "b"))
        rows = met.drop("lead")
        if not found.isEmpty():
            joined = components(found.select(F.col("label").alias("a"), F.col("other").alias("b")))
            rows = rows.join(joined.withColumnRenamed("id", "label"), "label", "left").withColumn("label", F.coalesce("component", "label"))
            rows = materialize(rows.select(*met.drop("lead").columns), "crowded_lines")
        mixed = materialize(_mixed(rows), "line_buckets")
        links.append(_across(rows.join(mixed.where(F.col("size") <= CROWDED), "h", "left_semi").select("h", "key", "label", "line").distinct()))
        rows = rows.join(mixed.where(F.col("size") > CROWDED), "h", "left_semi")
    return functools.reduce(DataFrame.unionByName, [materialize(found, "line_links") for found in links])


def _mixed(rows: DataFrame) -> DataFrame:
    """(h, size) of the buckets that hold lines of several classes. Two rows have met already: one of them is the smallest."""
    sizes = rows.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    return sizes.where("low <> high AND size > 2").select("h", "size")


def line_links(docs: DataFrame) -> DataFrame:
    """Links (a, b) between keys of different lines, enough to connect every class."""
    leads = _keys(docs, index_keys).groupBy("h").agg(F.min("id").alias("lead"), F.max("id").alias("last"))
    probes = _keys(docs, probe_keys)
    # A segment that very many lines hold is a skewed join, which AQE splits.
    met = probes.join(leads, "h").where("id <> lead OR lead <> last").select("h", "id", "lead", (F.col("lead") != F.col("last")).alias("several"))
    met = materialize(met, "met")
    stars = met.where("id <> lead").select(F.least("id", "lead").alias("left"), F.greatest("id", "lead").alias("right")).distinct()
    stars = materialize(stars, "stars")
    involved = materialize(stars.select(F.explode(F.array("left", "right")).alias("id")).distinct(), "line_ids")
    lines = materialize(_texts_of(docs, involved), "line_texts")
    links = materialize(_verified(stars, lines), "line_links")

    labels = components(links).select(F.col("id").alias("key"), F.col("component").alias("label"))
    members = met.where("several").select("h", "id").distinct().join(lines, "id").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    members = materialize(members.select("h", "key", "label", "line"), "line_members")
    mixed = materialize(_mixed(members), "line_buckets")
    links = links.unionByName(materialize(_across(members.join(mixed.where(F.col("size") <= CROWDED), "h", "left_semi")), "line_links"))
    crowded = mixed.where(F.col("size") > CROWDED)
    return links if crowded.isEmpty() else links.unionByName(_crowded(members, crowded))


def _marked(texts: DataFrame) -> DataFrame:
    """(id, text_key, line_no, n_chars, first, kept) of all lines of (id, text) that are not blank."""
    links = line_links(texts)
    classes = components(links)
    lines = _lines(texts)
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("line_no").alias("line_no"))
    firsts = lines.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    firsts = materialize(firsts, "line_firsts")
    grouped = firsts.join(classes.withColumnRenamed("id", "key"), "key")
    class_firsts = grouped.groupBy("component").agg(F.min("first").alias("first"))
    linked = grouped.select("key", "component").join(class_firsts, "component").select("key", "first")
    # Lines that occur once and are linked with none are their own class.
    several = firsts.where("n > 1").join(linked, "key", "left_anti").select("key", "first").unionByName(linked)
    found = lines.join(several, "key", "left")
    first = F.coalesce("first", place)
    return found.select("id", "text_key", "line_no", F.char_length("line").alias("n_chars"), first.alias("first"), (first == place).alias("kept"))


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line that is not blank: id, line_no (from 0), n_chars, class_id and class_line (first of its class), kept."""
    marked = _marked(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    return marked.select(F.col("id").alias(id_col), "line_no", "n_chars", F.col("first.id").alias("class_id"), F.col("first.line_no").alias("class_line"), "kept")


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, without the lines that repeat an earlier one. No document goes, though its text may become empty."""
    marked = _marked(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    gone = marked.where(~F.col("kept")).groupBy("id", "text_key").agg(F.collect_set("line_no").alias("gone"))

    @F.arrow_udf("string")
    def left(texts: pa.Array, gone: pa.Array) -> pa.Array:
        out = []
        for text, numbers in zip(texts.to_pylist(), gone.to_pylist()):
            if text is not None and numbers:
                numbers = set(numbers)
                text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in numbers)
            out.append(text)
        return pa.array(out, pa.string())

    rows = packed(docs, id_col, text_col).toDF("row", "own_id", "own_text").withColumn("own_key", F.xxhash64("own_text"))
    joined = rows.join(gone, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("text_key")), "left")
    shorter = joined.select("row", left("own_text", "gone").alias("shorter"))
    return unpacked(shorter.withColumn("row", F.col("row").withField(f"`{text_col}`", F.col("shorter"))), docs.columns)


def with_copies_whole(docs: DataFrame, most: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, without the lines that repeat an earlier one, but copies are not emptied.

    For a stage before one that compares documents. Documents with equal texts lose the same lines: those that the first of them
    loses. A text of whose characters (those of lines that are not blank) more than the share ``most`` would go keeps the lines
    that the document it shares most with has first, so that it is left like that one. No text with lines becomes empty.
    """
    marked = _marked(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    lost = marked.groupBy("text_key", "line_no").agg(F.max("kept").alias("kept"), F.min("first").alias("first"), F.max("n_chars").alias("n_chars")).where(~F.col("kept"))
    by_owner = lost.groupBy("text_key", "first.id").agg(F.collect_list("line_no").alias("lines"), F.sum("n_chars").alias("n_chars"))
    gone = by_owner.groupBy("text_key").agg(F.collect_list(F.struct("n_chars", "lines")).alias("gone"))

    @F.arrow_udf("string")
    def left(texts: pa.Array, gone: pa.Array) -> pa.Array:
        out = []
        for text, owners in zip(texts.to_pylist(), gone.to_pylist()):
            if text is not None and owners:
                lines = text.split("\n")
                size = sum(len(line) for line in lines if line.strip(" "))
                if sum(o["n_chars"] for o in owners) > most * size:
                    owners.remove(max(owners, key=lambda o: (o["n_chars"], -min(o["lines"]))))
                numbers = {i for o in owners for i in o["lines"]}
                text = "\n".join(line for i, line in enumerate(lines) if i not in numbers)
            out.append(text)
        return pa.array(out, pa.string())

    # A text that very many documents have is a skewed join, which AQE splits.
    rows = packed(docs, text_col).toDF("row", "own_text").withColumn("own_key", F.xxhash64("own_text"))
    joined = rows.join(gone, F.col("own_key") == F.col("text_key"), "left")
    shorter = joined.select("row", left("own_text", "gone").alias("shorter"))
    return unpacked(shorter.withColumn("row", F.col("row").withField(f"`{text_col}`", F.col("shorter"))), docs.columns)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_lines(table(spark, folder, "documents"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
