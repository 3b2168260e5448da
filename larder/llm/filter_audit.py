"""What each filter of a set removes, alone and in every order, from sorted posting lists.

Every document is judged by all filters once. Those that fail any become postings: lines (part, identifier, which filters
fail), lines alike counted together, sorted by part and identifier over range partitions. A range of identifiers of one part
is cut where an Arrow batch ends; in it each filter has the sorted list of the places that fail it. Unions of lists are k-way
merges that gallop: the list with the smallest head is searched, in doubling steps, for the next head of the others, and the
run before it is taken whole. Differences gallop in the same way. Each range gives the sizes of its 31 unions and 80
differences (one filter without the union of some others); sizes add up over ranges, and the table of all orders reads them
off. No task holds more than a batch; a part or an identifier that makes up most rows is spread or counted together.

Defined results: a null text counts as empty and a null part as the empty string; a duplicate is a text that some smaller
identifier has; rows without identifier are no duplicates and make none; rows that repeat an identifier are judged one by one
and all counted; a document is good or toxic if any of its labels says so, null labels saying nothing; an empty table gives
an empty result. Texts are judged whole. Other columns are never touched.
"""

from __future__ import annotations

import itertools
import math
import sys
from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import table
from larder.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
SYMBOLS = "[#$%&*|]"


def text_filters(text: Column) -> tuple[dict[str, Column], dict[str, Column]]:
    """Measures of a text, and the failure conditions built on them."""
    measures = {
        "_words": F.regexp_extract_all(text, F.lit(f"({WORD})")),
        "_chars": F.char_length(text),
        "_capitals": F.octet_length(F.regexp_replace(text, "[^A-Z]+", "")),
        "_symbols": text.rlike(SYMBOLS),
    }
    n = F.size("_words")
    return measures, {
        "A": n < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct("_words")) < LEAST_DISTINCT * n,
        "C": 100 * F.col("_capitals") > MOST_CAPITALS * F.col("_chars"),
        "D": F.col("_symbols"),
    }


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, fails, good, toxic) per row; bit i of ``fails`` is set where the i-th filter fails, A to E."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    named = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    measures, conditions = text_filters(F.col("text"))
    seen = named.select("id", "part", *[c.alias(name) for name, c in measures.items()], F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions.values())), F.lit(0))
    rows = materialize(seen.select("id", "part", "digest", bits.alias("bits")), "filter_rows")
    # Only texts that several identifiers have need their smallest one; a frequent digest on the left is a skewed join, which AQE splits.
    firsts = rows.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last")
    copies = rows.join(firsts, "digest", "left")
    marks = labels.groupBy(F.col(f"`{id_col}`").alias("label_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    marked = copies.join(marks, F.col("id") == F.col("label_id"), "left")
    twin = F.when(F.col("id") > F.col("first"), 1 << len(conditions)).otherwise(0)
    return marked.select(
        "id", "part", (F.col("bits") + twin).alias("fails"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


# --- posting lists --------------------------------------------------------------


def gallop(values: Sequence[int], wanted: int, start: int) -> int:
    """First place from ``start`` on whose value is ``wanted`` or more, searched in doubling steps."""
    step, low, n = 1, start, len(values)
    high = start
    while high < n and values[high] < wanted:
        low, high, step = high + 1, high + step, step * 2
    return bisect_left(values, wanted, low, min(high, n))


def union(lists: Sequence[list[int]]) -> list[int]:
    """Sorted distinct values of sorted lists of distinct values, by a galloping k-way merge."""
    heads = [[x, 0] for x in lists if x]
    out: list[int] = []
    while len(heads) > 1:
        lead = min(heads, key=lambda h: h[0][h[1]])
        values, at = lead
        smallest = values[at]
        following = None
        for other in heads:
            if other is not lead:
                if other[0][other[1]] == smallest:
                    other[1] += 1
                if other[1] < len(other[0]) and (following is None or other[0][other[1]] < following):
                    following = other[0][other[1]]
        end = len(values) if following is None else max(at + 1, gallop(values, following, at))
        out += values[at:end]
        lead[1] = end
        heads = [h for h in heads if h[1] < len(h[0])]
    for values, at in heads:
        out += values[at:]
    return out


def difference(values: list[int], without: list[int]) -> list[int]:
    """Values of a sorted list that are not in another one, galloping in both."""
    out: list[int] = []
    i = j = 0
    while i < len(values) and j < len(without):
        if values[i] < without[j]:
            end = gallop(values, without[j], i)
            out += values[i:end]
            i = end
        elif values[i] == without[j]:
            i, j = i + 1, j + 1
        else:
            j = gallop(without, values[i], j)
    return out + values[i:]


def range_sizes(fails: np.ndarray, weights: np.ndarray, filters: int) -> list[tuple[int, int, list[int]]]:
    """Of one range: (filter or -1, set of others, weights summed) of every union (-1) and every difference that is not empty."""
    lists = [np.flatnonzero(fails >> f & 1).tolist() for f in range(filters)]
    out, unions = [], {0: []}

    def put(f: int, others: int, places: list[int]) -> None:
        if places:
            out.append((f, others, weights[:, places].sum(axis=1).tolist()))

    for others in range(1, 1 << filters):
        unions[others] = union([lists[f] for f in range(filters) if others >> f & 1])
        put(-1, others, unions[others])
    for others, merged in unions.items():
        for f in range(filters):
            if not others >> f & 1:
                put(f, others, difference(lists[f], merged))
    return out


def set_sizes(rows: DataFrame, filters: int = 5) -> DataFrame:
    """(part, filter, others, n, good, toxic): how many documents fail ``filter`` and none of ``others``; filter -1: any of ``others``."""
    lines = rows.where("fails > 0").groupBy("part", "id", "fails", "good", "toxic").agg(F.count("*").alias("n"))
    # Written first: dealing by ranges reads it twice.
    postings = materialize(lines, "postings").repartitionByRange("part", "id", "fails", "good", "toxic").sortWithinPartitions("part", "id", "fails", "good", "toxic")

    def run(batches):
        totals: dict[tuple[str, int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            fails, n, good, toxic = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("fails", "n", "good", "toxic"))
            weights = np.stack([n, n * good, n * toxic])
            parts = batch.column("part").to_pylist()
            borders = [0, *[i for i in range(1, len(parts)) if parts[i] != parts[i - 1]], len(parts)]
            for start, end in itertools.pairwise(borders):
                for f, others, sums in range_sizes(fails[start:end], weights[:, start:end], filters):
                    key = (parts[start], f, others)
                    totals[key] = totals.get(key, 0) + np.array(sums, np.int64)
            if len(totals) > 100_000:
                yield from send(totals)
                totals = {}
        yield from send(totals)

    def send(totals):
        keys, sums = list(totals), list(totals.values())
        yield pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.int32()),
            *[pa.array([int(s[i]) for s in sums], pa.int64()) for i in range(3)]], names=["part", "filter", "others", "n", "good", "toxic"])

    found = postings.select("part", "fails", "n", "good", "toxic").mapInArrow(run, "part string, filter int, others int, n long, good long, toxic long")
    return found.groupBy("part", "filter", "others").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def order_steps(letters: str) -> list[tuple[str, int, int, int]]:
    """(order, step, filter, filters before as bits) of every order of the filters."""
    out = []
    for order in itertools.permutations(range(len(letters))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(letters[i] for i in order), step, f, before))
            before |= 1 << f
    return out


def audit(rows: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    filters, every = len(letters), (1 << len(letters)) - 1
    rows = materialize(rows, "judged")
    sizes = materialize(set_sizes(rows, filters), "set_sizes")
    zero = F.lit(0).cast("long")
    steps = F.array(*[
        F.struct(F.lit(order).alias("filter_order"), F.lit(step).alias("step"), F.lit(f).alias("filter"), F.lit(before).alias("before"),
                 F.lit(before | 1 << f).alias("after"), F.lit(every ^ 1 << f).alias("rest"))
        for order, step, f, before in order_steps(letters)])
    grid = rows.groupBy("part").agg(F.count("*").alias("_all")).select("part", "_all", F.inline(steps))

    def lookup(frame: DataFrame, f: Column, others: Column, **names: str) -> DataFrame:
        """``frame`` with sizes of the set that ``f`` and ``others`` name; sets that are not there are empty."""
        side = sizes.select(F.col("part").alias("_p"), F.col("filter").alias("_f"), F.col("others").alias("_o"), *[F.col(c).alias(n) for n, c in names.items()])
        joined = frame.join(side, (F.col("part") == F.col("_p")) & (f == F.col("_f")) & (others == F.col("_o")), "left")
        return joined.drop("_p", "_f", "_o").withColumns({n: F.coalesce(n, zero) for n in names})

    found = lookup(grid, F.col("filter"), F.col("before"), removed="n", good_lost="good", toxic_lost="toxic")
    found = lookup(found, F.lit(-1), F.col("after"), _failed="n")
    found = lookup(found, F.col("filter"), F.lit(0), _fails="n")
    found = lookup(found, F.col("filter"), F.col("rest"), unique_fails="n")
    # As many orders start with a set as it has orders itself, times those of the filters that follow.
    shares = sizes.where("filter >= 0").withColumn("_b", F.bit_count("others"))
    orders = F.create_map(*[F.lit(x) for b in range(filters) for x in (b, math.factorial(b) * math.factorial(filters - 1 - b))])
    values = shares.groupBy(F.col("part").alias("_p"), F.col("filter").alias("_f")).agg(F.sum(F.col("n") * orders[F.col("_b")]).alias("shapley"))
    found = found.join(values, (F.col("part") == F.col("_p")) & (F.col("filter") == F.col("_f")), "left")
    return found.select(
        "part", "filter_order", "step", (F.col("_all") - F.col("_failed")).alias("kept"), "removed", (F.col("_fails") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", F.coalesce("shapley", zero).alias("shapley"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return audit(judged(table(spark, folder, "documents"), table(spark, folder, "labels")))


SQL = r"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
m AS MATERIALIZED (SELECT part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(doc_id > first_id, false) AS e, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM d LEFT JOIN l USING (doc_id)),
bits AS MATERIALIZED (SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
    || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS f,
    count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM m GROUP BY ALL),
one(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM one p, one q, one r, one s, one t
  WHERE p.x NOT IN (q.x, r.x, s.x, t.x) AND q.x NOT IN (r.x, s.x, t.x) AND r.x NOT IN (s.x, t.x) AND s.x <> t.x),
steps AS (SELECT filter_order, CAST(k AS INTEGER) AS step, filter_order[CAST(k AS INTEGER)] AS x, filter_order[1:CAST(k AS INTEGER) - 1] AS before FROM orders, range(1, 6) g(k)),
cells AS (SELECT part, filter_order, step, x, n, good, toxic, f,
    before <> '' AND f <> translate(f, before, '') AS gone, contains(f, x) AS fails FROM bits, steps),
counted AS (SELECT part, filter_order, step, x,
    coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS kept, coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE gone AND fails), 0) AS redundant, coalesce(sum(n) FILTER (WHERE f = x), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0) AS toxic_lost
  FROM cells GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM counted
"""

cloudpickle.register_pickle_by_value(sys.modules[__name__])
