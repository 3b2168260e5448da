"""Buckets of lines that share a segment and are no copies of one another."""

import random
import time

import pytest

from larder.llm import line_dedup
from tests.llm.test_operators import closed, edited, edits

ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def words(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


def classes(spark, lines):
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(4)
    return {r.doc_id: r.class_id for r in line_dedup.duplicate_lines(docs).collect()}


def near(a, b):
    shorter = min(len(a), len(b))
    return abs(len(a) - len(b)) <= 2 and edits(a, b) <= (2 if shorter >= 24 else 1 if shorter >= 12 else 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_split_buckets_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(line_dedup, "BLOCK", 4)
    monkeypatch.setattr(line_dedup, "CROWDED", 6)
    rng = random.Random(seed)
    start, end = words(rng, 20), words(rng, 9)
    lines = []
    for _ in range(14):
        for shape in (start + words(rng, 8), words(rng, 9) + start, start + words(rng, 3) + end, words(rng, 4) + start + words(rng, 4), start[:12] + words(rng, 3), "ab" * 14 + words(rng, 2)):
            lines += [shape, *(edited(rng, shape, times, ALPHABET) for times in (1, 2, 2)[: rng.randint(0, 3)])]
    lines += [start + a + b for a in "xyz" for b in ("", "u", "vw", "wvu")]
    lines = list(dict.fromkeys(lines))
    rng.shuffle(lines)
    expected = closed([(p, q) for p, a in enumerate(lines) for q in range(p) if near(a, lines[q])], range(len(lines)))
    assert classes(spark, lines) == expected
    assert len(set(expected.values())) > 30 and len(set(expected.values())) < len(lines) - 30


def test_remainders_of_linked_lines_share_a_cut():
    """Whatever segment two lines within reach share, what is left of them shares one again, down to the last characters."""
    rng = random.Random(4)

    def cuts(rest, length, limit, indexed):
        found = [(i, p, w) for i, (p, w) in enumerate(line_dedup.partition(length, limit + 1))] if indexed else line_dedup.places(len(rest), length, limit)
        return {(i, rest[q : q + w]): rest[:q] + rest[q + w :] for i, q, w in found}

    for _ in range(2000):
        a = "".join(rng.choice("ab ") for _ in range(rng.randint(26, 50)))
        a, b = sorted((a, edited(rng, a, rng.randint(0, 2), "ab ")), key=len)
        limit = line_dedup.edits_of(len(a))
        pairs, length = {(a, b)}, len(a)
        while pairs and length > limit:
            found = [(left[k], right[k]) for x, y in pairs for left, right in [(cuts(x, len(x), limit, True), cuts(y, len(x), limit, False))] for k in left.keys() & right.keys()]
            pairs = {(x, y) for x, y in found if edits(x, y) <= limit}
            assert pairs, (a, b)
            shortest = min(len(x) for x, _ in pairs)
            pairs, length = {p for p in list(pairs)[:3] if len(p[0]) > limit} or set(), shortest


def test_lines_with_a_common_start_do_not_all_meet(spark, monkeypatch):
    rng = random.Random(5)
    start = words(rng, 36)
    lines = [start + words(rng, 16) for _ in range(3000)]
    lines += [edited(rng, line, 1, ALPHABET) for line in lines[:200]]
    sizes, across = [], line_dedup._across

    def counted(members):
        sizes.append([r["count"] for r in members.groupBy("h").count().collect()])
        return across(members)

    monkeypatch.setattr(line_dedup, "_across", counted)
    begun = time.perf_counter()
    found = classes(spark, lines)
    assert time.perf_counter() - begun < 120
    assert all(found[3000 + i] == found[i] for i in range(200)) and len(set(found.values())) >= 2990
    # Without the split one bucket alone would compare 5 million pairs.
    assert sum(n * n for step in sizes for n in step) < 1_000_000


def test_lines_that_differ_in_their_last_characters(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "CROWDED", 4)
    start = "an order of the same customer, number "
    lines = [f"{start}{i:03d}" for i in range(60)] + [f"{start}{c}" for c in ("", "1", "abcd", "abcde")]
    expected = closed([(p, q) for p, a in enumerate(lines) for q in range(p) if near(a, lines[q])], range(len(lines)))
    assert classes(spark, lines) == expected
