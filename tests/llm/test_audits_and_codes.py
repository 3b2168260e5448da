"""Vector codes, filter audit and repeat removal against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import filter_audit, repeat_removal, vector_codes

# --- 11 vector codes ------------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds, scale):
    """Codes, errors and codebooks by loops over Python integers."""
    whole = [[int(np.floor(float(x) * scale)) for x in v] for v in rows]
    size = len(whole[0]) // parts
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for v in whole]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def best(part, book):
        apart = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return apart.index(min(apart)), min(apart)

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for v in cut:
                members.setdefault(best(v[p], books[p])[0], []).append(v[p])
            for e, some in members.items():
                books[p][e] = [sum(x) // len(some) for x in zip(*some)]
    found = [[best(v[p], books[p]) for p in range(parts)] for v in cut]
    return [[c for c, _ in f] for f in found], [[e for _, e in f] for f in found], books


def test_products_of_limbs_are_exact():
    rng = np.random.default_rng(1)
    for bits in (5, 11, 20, None):
        a, b = rng.integers(-(2**27), 2**27, (9, 33)), rng.integers(-(2**27), 2**27, (33, 7))
        expected = [[sum(int(x) * int(y) for x, y in zip(row, column)) for column in b.T] for row in a]
        assert vector_codes.exact_product(a, b, bits).tolist() == expected
    assert all(terms * 2 ** (2 * vector_codes.limb_bits(terms)) <= 2**53 for terms in (1, 2, 3, 64, 4096, 100_000))
    parts = vector_codes.limbs(np.array([-(2**40), -1, 0, 2**40 - 7]), 12)
    assert sum(x * 2.0 ** (12 * i) for i, x in enumerate(parts)).tolist() == [-(2**40), -1, 0, 2**40 - 7]


def test_vector_codes_equal_plain_loops(spark):
    rng = np.random.default_rng(3)
    rows = rng.normal(0, 2, (60, 12)).round(1).tolist()
    rows[20], rows[21] = rows[3], rows[3]
    odd = [(100, None, 1), (101, [None] + [0.0] * 11, 1), (102, [float("nan")] * 12, 2), (103, [float("inf")] + [0.0] * 11, None)]
    data = [(i, v, i % 3 or None) for i, v in enumerate(rows)]
    df = spark.createDataFrame(random.Random(1).sample(data + odd, 64), "vec_id long, embedding array<double>, label int").repartition(5)
    found, books = vector_codes.compress(df, parts=3, entries=7, rounds=4, scale=16)
    lines = {r["row"]["vec_id"]: (r["codes"], r["errors"]) for r in found.collect()}
    codes, errors, plain = plain_codes(rows, 3, 7, 4, 16)
    assert lines == {i: (c, e) for i, (c, e) in enumerate(zip(codes, errors))}
    assert books.tolist() == plain


def test_vector_codes_of_few_and_odd_rows(spark):
    kind = "vec_id long, embedding array<float>, label int, row string, codes int"
    empty = spark.createDataFrame([], kind)
    found, books = vector_codes.compress(empty)
    assert found.collect() == [] and books is None
    few = [(None, [0.5] * 8, None, "a", 1), (2, [1.0] * 8, None, "b", 2), (2, [1.0] * 8, 1, "c", 3)]
    found, books = vector_codes.compress(spark.createDataFrame(few, kind))
    assert books.shape == (8, 3, 1)
    # The first of equal entries is taken; the row without identifier started the last one.
    assert {r["row"]["row"]: r["codes"][0] for r in found.collect()} == {"a": 2, "b": 0, "c": 0}
    with pytest.raises(Exception, match="multiple of 8"):
        vector_codes.compress(spark.createDataFrame([(1, [1.0] * 9, None, "", 1)], kind))
    with pytest.raises(Exception, match="64 bits"):
        vector_codes.compress(spark.createDataFrame([(1, [1e30] * 8, None, "", 1)], kind))


# --- 12 filter audit ------------------------------------------------------------------


def test_galloping_merges():
    rng = random.Random(2)
    for _ in range(300):
        lists = [sorted(rng.sample(range(60), rng.randint(0, 40))) for _ in range(rng.randint(1, 5))]
        assert filter_audit.union(lists) == sorted(set().union(*lists))
        a, b = lists[0], lists[-1]
        assert filter_audit.difference(a, b) == sorted(set(a) - set(b))
    long, short = list(range(0, 100_000, 3)), [9, 30_001, 99_999]
    assert filter_audit.union([long, short]) == sorted(set(long) | set(short))
    assert filter_audit.gallop(long, 50_000, 5) == 16_667


def plain_audit(rows):
    """(part, order, step) to counts, by walking through every order; rows are (part, set of failing letters, good, toxic)."""
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removed_by[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f in r[1] for r in own) - len(gone), sum(r[1] == {f} for r in own),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), line in out.items():
            if p == part:
                line.append(removed_by[order[step - 1]])
    return out


def test_audit_equals_a_walk_through_every_order(spark):
    rng = random.Random(4)
    good, bad = "plain words here " * 40, "x # y"
    distinct = " ".join(f"word{i}" for i in range(120))
    texts = [good, bad, "", None, distinct, distinct.upper(), distinct + " $", "A" * 300, " ".join(["same"] * 200), "tabs\tand\nlines " * 60]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(150)]
    docs += [(5, docs[5][1], docs[5][2]), (5, docs[5][1], docs[5][2]), (7, "another text", "en"), (None, distinct, "xx"), (None, distinct, "xx"), (500, distinct, "lone")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(2, 1, 1), (None, 1, 1), (9999, 1, 1)]
    frame = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, lang string, part string, fails int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    smallest, rows = {}, []
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    good_ids, toxic_ids = ({i for i, *m in labels if m[k] == 1 and i is not None} for k in (0, 1))
    for i, t, part in docs:
        t = t or ""
        words = t.split()
        fails = {f for f, bad in {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > smallest[t]}.items() if bad}
        rows.append((part or "", fails, i in good_ids, i in toxic_ids))
    found = filter_audit.audit(filter_audit.judged(frame, marks)).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in found} == plain_audit(rows)
    assert len(found) == 600 * len({r[0] for r in rows})


def test_audit_of_nothing_and_of_clean_texts(spark):
    kind = "doc_id long, text string, lang string"
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.judged(spark.createDataFrame([], kind), marks)).collect() == []
    clean = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(100)), "en")], kind)
    found = filter_audit.audit(filter_audit.judged(clean, marks)).collect()
    assert len(found) == 600 and {(r["kept"], r["removed"], r["shapley"]) for r in found} == {(1, 0, 0)}


# --- 13 repeat removal ----------------------------------------------------------------


def plain_removal(docs, window):
    """Removed places of each document, by comparing all windows."""
    first, gone = {}, {}
    places = sorted((i, s) for i, t in docs for s in range(len(t.split()) - window + 1))
    texts = dict(docs)
    for i, s in places:
        key = tuple(texts[i].split()[s : s + window])
        if first.setdefault(key, (i, s)) != (i, s):
            gone.setdefault(i, set()).update(range(s, s + window))
    return gone


def random_corpus(rng, n):
    words = [f"w{i}" for i in range(40)]
    passages = [" ".join(rng.choices(words, k=rng.randint(3, 40))) for _ in range(6)]
    def one():
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randint(1, 12))) for _ in range(rng.randint(0, 8))]
        return rng.choice([" ", "\n", "\t "]).join(parts)
    docs = [(i, one()) for i in rng.sample(range(10 * n), n)]
    return docs + [(10 * n + i, docs[rng.randrange(n)][1]) for i in range(5)] + [(20 * n, "a " * 50), (20 * n + 1, "a b " * 30)]


@pytest.mark.parametrize("window", [6, 9, 20])
def test_repeats_equal_brute_force(spark, window, monkeypatch):
    # Small shards and slices, so that passages meet in many groups.
    monkeypatch.setattr(repeat_removal, "SHARD_WORDS", 60)
    monkeypatch.setattr(repeat_removal, "SLICE_ANCHORS", 8)
    monkeypatch.setattr(repeat_removal, "PIECE_BITS", 4)
    docs = random_corpus(random.Random(window), 60)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, doc int, words string").repartition(4)
    gone = plain_removal(docs, window)
    assert len(gone) > 10
    for r in repeat_removal.without_repeats(df, window=window).collect():
        words, out = dict(docs)[r["doc_id"]].split(), gone.get(r["doc_id"], set())
        assert (r["n_words"], r["n_removed"]) == (len(words), len(out))
        assert r["kept"] == " ".join(w for i, w in enumerate(words) if i not in out)
        assert {i for a, b in r["spans"] for i in range(a, b + 1)} == out


def test_windows_beside_a_first_anchor_are_found(spark):
    # Documents 2 and 3 share a window whose anchor lies in document 1 as well, in other words.
    core = " ".join(f"c{i}" for i in range(8))
    docs = [(i, f"{a} {core} {b}") for i, (a, b) in enumerate([("x1 x2 x3 x4 x5 x6", "y1 y2 y3 y4 y5 y6"), ("p1 p2 p3 p4 p5 p6", "q1 q2 q3 q4 q5 q6"), ("p1 p2 p3 p4 p5 p6", "q1 q2 q3 q4 q5 q6 q7")])]
    found = repeat_removal.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"), window=20).collect()
    assert {r["doc_id"]: r["kept"] for r in found} == {0: docs[0][1], 1: docs[1][1], 2: "q7"}


def test_matching_statistics_equal_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        passages = [(i, rng.randint(0, 9), [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 15))]) for i in range(3)]
        automaton = repeat_removal.Automaton(passages)
        asked = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(20)]
        for i, (matched, first) in enumerate(automaton.matches(asked, 4)):
            longest = max((n for n in range(1, i + 2) for _, _, w in passages if any(w[k : k + n] == asked[i + 1 - n : i + 1] for k in range(len(w)))), default=0)
            assert min(matched, 4) == min(longest, 4)
            if longest >= 4:
                ends = [(d, s + k + 3) for d, s, w in passages for k in range(len(w) - 3) if w[k : k + 4] == asked[i - 3 : i + 1]]
                assert first == min(ends)


def test_odd_documents(spark):
    text = " ".join(f"t{i}" for i in range(30))
    docs = [(None, text), (3, text), (3, text), (4, None), (5, ""), (6, " \n"), (7, text + " more"), (8, "short one"), (9, "short one"), (10, " ".join(["z"] * 3000))]
    found = repeat_removal.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    lines = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in found)
    assert lines == [(False, 3, 30, 0), (False, 3, 30, 0), (False, 4, 0, 0), (False, 5, 0, 0), (False, 6, 0, 0), (False, 7, 31, 30),
                     (False, 8, 2, 0), (False, 9, 2, 0), (False, 10, 3000, 2999), (True, 0, 30, 0)]
    assert repeat_removal.without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    named = spark.createDataFrame([("b", text), ("a", text)], "doc_id string, text string")
    assert {r["doc_id"]: r["n_removed"] for r in repeat_removal.without_repeats(named).collect()} == {"a": 0, "b": 30}
