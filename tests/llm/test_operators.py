"""Operators against libraries, brute force and exact round trips."""

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from larder.llm import exact_dedup, hamming_search, language_id, line_dedup, near_dedup, pieces, quality_vote, source_mix, token_count, warc
from larder.llm.components import components
from larder.session import scratch_path

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LETTERS = [*map(chr, range(0x250)), *map(chr, range(0x2000, 0x2070)), *"漢字かな한글😀👍🏽́ः​﻿\x1c\x85　"]


def random_text(rng, most=30):
    return "".join(rng.choice(LETTERS if rng.random() < 0.5 else " \n\tabcdefghst'12") for _ in range(rng.randint(0, most)))


def closed(links, vertices):
    """Smallest vertex reachable from each, by union and find."""
    parent = {v: v for v in vertices}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {v: root(v) for v in vertices}


# --- 1 token counts -------------------------------------------------------------------


def test_token_counts_equal_the_library():
    from tokenizers import Tokenizer

    library, counts, rng = Tokenizer.from_file(BPE), token_count.Counts(token_count.read_model(BPE)), random.Random(1)
    samples = [random_text(rng) + rng.choice(["", "", "", "<|endoftext|>"]) + random_text(rng, 5) for _ in range(3000)]
    samples += ["", " ", "a" * 5000, "ab" * 20_000, "<|endoftext|><|endoftext|>", "\n\n  x"]
    for text in samples:
        assert counts.text(text) == len(library.encode(text, add_special_tokens=False).ids), text[:60]


def test_long_texts_are_counted_in_slices(monkeypatch):
    counts = token_count.Counts(token_count.read_model(BPE))
    text = "words and more words, 12 of them. " * 50
    whole = counts.text(text)
    monkeypatch.setattr(token_count, "AT_ONCE", 7)
    assert counts.text(text) == whole


# --- 2 archives ----------------------------------------------------------------------


def test_payloads_survive_framing_and_segments():
    rng = random.Random(2)
    for n in [0, 1, 4095, 4096, 4097, 32768, 100_001]:
        payload = bytes(rng.randrange(256) for _ in range(n)) + b"\r\n\r\nWARC/1.1\r\nWARC/1.1\r\n" * 3
        message = b"HTTP/1.1 200 OK\r\n\r\n" + warc.chunked(payload)
        assert warc.VERSION.encode() not in message
        parts = warc.segments(message, 50)
        assert b"".join(parts) == message and max(map(len, parts)) <= 50
        assert warc.unchunked(message) == payload


def test_broken_framing_is_noticed():
    with pytest.raises(ValueError):
        warc.unchunked(b"HTTP/1.1 200 OK\r\n\r\n5\r\nabc\r\n0\r\n\r\n")


def test_archives_round_trip(spark):
    big = "<p>€" + "x" * 200_000
    rows = [(1, "http://a/1 \r\nX: y", big), (2, "u", "y" * 200), (3, "u", "y" * 200), (4, "v", None), (5, None, ""), (6, "w", "small"), (7, "w", "small"),
            (8, "t", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40), (None, "n", "y" * 200), (9, "same", big), (9, "same", big), (3, "u", "y" * 200)]
    path = scratch_path(spark, "warc_test")
    warc.write_pages(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")), path)
    responses, revisits = warc.read_pages(spark, path)
    read = responses.select(warc.page_of(F.col("record_id")).alias("page"), "payload").collect()
    found = sorted((-1 if r.page is None else r.page, bytes(r.payload).decode()) for r in read)
    assert found == sorted([(1, big), (2, "y" * 200), (4, ""), (5, ""), (6, "small"), (7, "small"), (8, rows[7][2])])
    again = sorted((-1 if r.p is None else r.p, r.q) for r in revisits.select(warc.page_of(F.col("record_id")).alias("p"), warc.page_of(F.col("refers_to")).alias("q")).collect())
    assert again == [(-1, 2), (3, 2), (3, 2), (9, 1), (9, 1)]


def test_repeated_segmented_records_come_back_as_often(spark):
    page = (4, "u", "z" * 90 + "é" * 50_000)
    path = scratch_path(spark, "warc_test")
    warc.write_pages(spark.createDataFrame([page, page], "page_id long, url string, html string"), path)
    responses, revisits = warc.read_pages(spark, path)
    assert [bytes(r.payload).decode() for r in responses.collect()] == [page[2]] * 2 and revisits.isEmpty()


def test_records_across_the_line_reader_s_buffer(spark):
    # Records of every length around its 64 KiB, with line breaks that look like the start of a separator.
    rows = [(i, "u", "\r\n" * (32_600 + i % 40) + str(i)) for i in range(120)]
    path = scratch_path(spark, "warc_test")
    warc.write_pages(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    responses, _ = warc.read_pages(spark, path)
    assert sorted((r.page, bytes(r.payload).decode()) for r in responses.select(warc.page_of(F.col("record_id")).alias("page"), "payload").collect()) == [(i, h) for i, _, h in rows]


def test_versions_before_line_breaks_of_the_framing(spark):
    version = "WARC/1.1"
    # A payload and an address that end in it; one where it ends with a chunk; it ending at each place around a segment's end.
    pages = ["foo " + version, version, "x" * (warc.CHUNK - 8) + version, "x" * (warc.CHUNK - 8) + version + "\r\nmore", version * 900 + "\r\n"]
    pages += ["x" * (warc.SEGMENT - n) + version + "y" * 500 for n in range(60, 240)]
    rows = [(i, "http://a/" + version, html) for i, html in enumerate(pages)]
    assert all(version.encode() not in warc.chunked(html.encode()) and warc.unchunked(b"\r\n\r\n" + warc.chunked(html.encode())) == html.encode() for html in pages)
    path = scratch_path(spark, "warc_test")
    warc.write_pages(spark.createDataFrame([*rows, (999, "http://a/" + version, pages[2])], "page_id long, url string, html string"), path)
    responses, revisits = warc.read_pages(spark, path)
    found = responses.select(warc.page_of(F.col("record_id")).alias("page"), "uri", "payload").collect()
    assert sorted((r.page, r.uri, bytes(r.payload).decode()) for r in found) == [(i, "http://a/WARC/1%2E1", html) for i, _, html in rows]
    assert [r.uri for r in revisits.collect()] == ["http://a/WARC/1%2E1"]


def test_a_cut_record_stops_the_job(spark):
    path = scratch_path(spark, "warc_test")
    line = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 50\r\n\r\nshort".decode()
    spark.createDataFrame([(line,)], "value string").write.option("lineSep", warc.END).text(path)
    with pytest.raises(Exception, match="another length"):
        warc.read_pages(spark, path)[0].collect()


# --- 3 search ------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [40, 100])
def test_search_equals_brute_force(spark, bits):
    rng = np.random.default_rng(bits)
    centres = rng.standard_normal((6, bits))
    vectors = centres[rng.integers(0, 6, 240)] + 0.4 * rng.standard_normal((240, bits))
    vectors[50:90] = vectors[50]  # one code of many rows
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(7, vectors[7].tolist()), (None, vectors[3].tolist()), (500, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("code", F.lit("clash"))
    found = {(r.vec_id, r.rank): (r.distance, r.neighbour_id) for r in hamming_search.search(df, df.where("vec_id % 20 = 0"), 5, bits=bits).collect()}
    sign = vectors >= 0
    expected = {}
    for q in range(0, 240, 20):
        order = sorted((int((sign[q] != sign[i]).sum()), i) for i in range(240) if i != q)
        expected |= {(q, rank + 1): pair for rank, pair in enumerate(order[:5])}
    assert found == expected


def test_search_of_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, -1.0]), (1, [float("nan"), 2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in hamming_search.search(df, df, 3).orderBy("vec_id").collect()] == [(0, 1, 1, 1), (1, 0, 1, 1)]
    assert hamming_search.search(df.limit(0), df, 3).isEmpty()


def test_components_behind_the_64th_count(spark):
    rows = [(0, [1.0] * 70), (1, [1.0] * 64 + [-1.0] * 6), (2, [-1.0] + [1.0] * 69)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = hamming_search.search(df, df.where("vec_id = 0"), 2).orderBy("rank").collect()
    assert [tuple(r) for r in found] == [(0, 2, 1, 1), (0, 1, 6, 2)]
    with pytest.raises(ValueError, match="70 components"):
        hamming_search.search(df, df, 2, bits=64)


def test_blocks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(hamming_search, "INDEX_BLOCK", 16)
    df = spark.range(500).select(F.lit(0).alias("segment"), F.lit(1).alias("value"), "id")
    sizes = [len(r.ids) for r in hamming_search._packed(df, F.col("id"), 16, "ids").collect()]
    assert sum(sizes) == 500 and max(sizes) <= 40


# --- 4 languages ---------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    df = language_id.query(spark, "/root/testdata/sf0.01")
    found = df.join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97
    assert sum(r.rejected for r in found) / len(found) < 0.02
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_texts_of_unknown_language(spark):
    sure = [(i, text, lang, "s") for i in range(20) for text, lang in [("the cat and the other thing", "en"), ("el gato y la otra cosa", "es")]]
    odd = [(100, None, None, None), (101, "", "en", "s"), (102, "12 !?", None, "s"), (None, "the other cat", "en", None), (103, "the cat " * 200_000, None, "s"), (100, None, None, None)]
    docs = spark.createDataFrame(sure + odd, "doc_id long, text string, lang string, row string").withColumn("found", F.lit(1))
    kept = language_id.keep_known(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 103 in ids and None in ids and not {100, 101, 102} & set(ids)
    assert language_id.keep_known(docs.limit(0)).isEmpty()
    assert language_id.keep_known(docs.withColumn("lang", F.lit(None).cast("string"))).isEmpty()


def test_many_languages_are_all_learnt(spark, monkeypatch):
    docs = spark.range(450 * 6).selectExpr("id AS doc_id", "concat('l', id % 450) AS lang", "concat('word', id) AS text")
    model = language_id.fit(docs, F.lit(True))
    assert len(model.languages) == 450
    # The total is shared.
    monkeypatch.setattr(language_id, "TOTAL", 900)
    sample = language_id._sample(docs, F.lit(True), "doc_id", "text", "lang").groupBy("language").count().collect()
    assert len(sample) == 450 and max(r["count"] for r in sample) == 2
    found = docs.limit(5).select(language_id.predicted(F.col("text"), model, spark).alias("p")).collect()
    assert all(r.p.lang_pred in model.languages for r in found)
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 449)
    with pytest.raises(ValueError, match="more than 449"):
        language_id.fit(docs, F.lit(True))


def test_subwords_do_not_depend_on_the_block(monkeypatch):
    subwords = language_id.Subwords()
    codes, _ = subwords.codes("Straße, naïve façade 12 ещё слово")
    whole = np.sort(np.concatenate(list(subwords.blocks(codes))))
    monkeypatch.setattr(language_id, "BLOCK", 5)
    assert np.array_equal(np.sort(np.concatenate(list(subwords.blocks(codes)))), whole)


# --- 5 near duplicates ---------------------------------------------------------------


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def near_by_brute_force(rows):
    known = {i: shingle_set(t) for i, t in rows}
    links = [(a, b) for a in known for b in known
             if a < b and known[a] and 100 * len(known[a] & known[b]) >= 85 * len(known[a] | known[b])]
    return known, closed(links, known)


def check_near(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("id", F.lit(-1))
    found = near_dedup.near_duplicates(docs).collect()
    sets, groups = near_by_brute_force([r for r in rows if r[0] is not None])
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), groups[r.doc_id], groups[r.doc_id] == r.doc_id)


def test_near_duplicates_equal_brute_force(spark, sf):
    check_near(spark, [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()])


@pytest.mark.parametrize("block", [512, 6])
def test_near_duplicates_at_the_edges(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one\x0btwo"), (5, "one two"), (None, "one two"), (8, "long " * 50_000), (9, "LONG " * 60_000)]
    # A family in which each is linked with its neighbours only: words are replaced one after the other.
    for i in range(40):
        base[7 * i] = f"new{i}"
        rows.append((100 + i, " ".join(base)))
    rows += [(200 + i, " ".join(base[:150]) + f" tail{i} a b c d") for i in range(30)]
    # 94 shingles, 8 of them changed: 86 of 102, below; and 7 changed: 87 of 101, above.
    words = [f"q{i}" for i in range(98)]
    rows += [(300, " ".join(words)), (301, " ".join(words[:-8] + ["z"] * 8)), (302, " ".join(words[:-7] + [f"y{i}" for i in range(7)]))]
    rows.append((3, "One two"))
    check_near(spark, rows)
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).isEmpty()


def test_similarity_is_a_parameter(spark):
    words = [f"q{i}" for i in range(98)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:-10] + [f"y{i}" for i in range(10)]))], "doc_id long, text string")
    # 84 of 104 shingles are common: more than four fifths, less than 85 per cent.
    assert near_dedup.keep_one(docs).count() == 2
    assert near_dedup.keep_one(docs, similarity=80).count() == 1


def test_pruning_limits_keep_the_chosen_miss_probability():
    for n, least in near_dedup.least_matches():
        below = sum(math.comb(n + 1, k) * 0.85**k * 0.15 ** (n + 1 - k) for k in range(least))
        assert below < near_dedup.MISS <= below + math.comb(n + 1, least) * 0.85**least * 0.15 ** (n + 1 - least)


def test_kept_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", None), (None, "a b c d e f", "y"), (3, None, "z")], "doc_id long, text string, row string")
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.row for r in kept.collect()) == ["x", "y", "z"]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(7, 7)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = closed(links, {v for link in links for v in link})
    assert found == {v: c for v, c in expected.items() if any(v in link and link[0] != link[1] for link in links)}


# --- 6 mixing -----------------------------------------------------------------------


@pytest.mark.parametrize("rate", [0.0, 0.3, 1.0, 7.5, 40.0, 900.0])
def test_poisson_distribution(spark, rate):
    cdf = spark.range(1).select(source_mix.poisson_cdf(F.lit(rate)).alias("cdf")).first().cdf
    total = 0.0
    for k, value in enumerate(cdf):
        total += math.exp(-rate + (k * math.log(rate) if rate else 0.0) - math.lgamma(k + 1)) if rate or k == 0 else 0.0
        assert value == pytest.approx(total, abs=1e-9)
    assert cdf[-1] == pytest.approx(1.0, abs=1e-9)


def test_high_rates_have_short_distributions(spark):
    rates = [(None, 1500.0), ("a", 1e6), ("b", 3e8)]
    found = {r.mix_source: r for r in source_mix.high_cdf(spark.createDataFrame(rates, "mix_source string, rate double")).collect()}
    for name, rate in rates:
        least, cdf = found[name].least, np.array(found[name].cdf)
        assert len(cdf) <= 20 * math.sqrt(rate) + 63 and cdf[0] < 1e-16 and cdf[-1] == pytest.approx(1.0, abs=1e-9)
        places = np.arange(least, least + len(cdf))
        terms = np.diff(cdf, prepend=0.0)
        mean = float(terms @ (places - rate))
        assert abs(mean) < 1e-3 * math.sqrt(rate) and float(terms @ (places - rate - mean) ** 2) == pytest.approx(rate, rel=1e-3)
    at = found[None]
    exact = np.cumsum([math.exp(-1500.0 + k * math.log(1500.0) - math.lgamma(k + 1)) for k in range(at.least, at.least + len(at.cdf))])
    assert np.abs(exact - np.array(at.cdf)).max() < 1e-9
    docs = spark.createDataFrame([(1, "x", "tiny"), (2, "y" * 3_000_000, "large")], "doc_id long, text string, source string")
    rate = source_mix.source_rates(docs, {}).where("mix_source = 'tiny'").first()
    assert rate.rate > 1e6 and rate.least > 1e6 and len(rate.cdf) < 30_000
    copies = source_mix.replicate(docs, {}).where("row.doc_id = 1").agg(F.count("*").alias("n"), F.max("n_copies").alias("m")).first()
    assert copies.n == copies.m == pytest.approx(rate.rate, rel=0.01)


def test_sources_reach_their_weights(spark):
    rows = [(i, "x" * 10, "a" if i < 6000 else "b" if i < 7500 else None) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("row", F.lit("clash")).withColumn("rate", F.lit(9))
    mixed = source_mix.replicate(docs, {"a": 1.0, "b": 2.0}, other=1.0).select("row.*", "copy", "n_copies", "shuffle_key").collect()
    share = {s: sum(r.source == s for r in mixed) / len(mixed) for s in ("a", "b", None)}
    assert share["a"] == pytest.approx(0.25, abs=0.02) and share["b"] == pytest.approx(0.5, abs=0.02)
    assert len(mixed) == pytest.approx(8000, rel=0.04)
    assert [r.shuffle_key for r in mixed] == sorted(r.shuffle_key for r in mixed)
    assert len({(r.doc_id, r.copy) for r in mixed}) == len(mixed)


def test_mixing_at_the_edges(spark):
    rows = [(None, "a", "s"), (1, None, None), (1, None, None), (2, "", "empty"), (3, "x" * 100_000, "gone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = source_mix.replicate(docs, {"gone": 0.0}).select("row.*", "n_copies").collect()
    assert all(r.source != "gone" for r in mixed)
    assert len({r.n_copies for r in mixed if r.doc_id == 1}) <= 1
    assert source_mix.replicate(docs.limit(0), {"a": 1.0}).isEmpty()


# --- 7 exact duplicates -----------------------------------------------------------------


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_duplicates(spark, keep):
    rows = [(1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (None, "a"), (None, "only"), (2, "a"), (6, "x" * 1_000_000), (7, "x" * 1_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("n", F.lit("clash")).withColumn("digest", F.lit(0))
    found = sorted(exact_dedup.exact_dedup(docs, keep=keep, runs=16, fan_in=2).collect(), key=str)
    same = {}
    for i, t in rows:
        same.setdefault(t or "", []).append(i)
    pick = min if keep == "smallest" else max
    expected = []
    for i, t in rows:
        ids = [j for j in same[t or ""] if j is not None]
        stays = pick(ids) if ids else None
        expected.append((i, stays, len(same[t or ""]), i == stays, hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert exact_dedup.exact_dedup(docs.limit(0)).isEmpty()


@pytest.mark.parametrize("runs,fan_in,rounds", [(64, 2, 6), (64, 4, 3), (5, 2, 3), (1, 2, 0)])
def test_every_round_sorts_its_runs_and_merges_them(spark, runs, fan_in, rounds):
    schema = "run long, slice long, digest binary, id long, n long, _len_lo int, _len_hi int, _sum_lo long, _sum_hi long"
    plan = exact_dedup.merge_runs(spark.createDataFrame([], schema), runs=runs, fan_in=fan_in)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window [") == rounds and "Aggregate" not in plan and "Python" not in plan
    rng = random.Random(runs + fan_in)
    lines = [(run, d % 3, bytes([d]), rng.choice([None, rng.randrange(1000)]), rng.randint(1, 5), d, d, d, d) for run in range(runs) for d in range(40) if rng.random() < 0.6]
    for keep, pick in (("smallest", min), ("largest", max)):
        merged = exact_dedup.merge_runs(spark.createDataFrame(lines, schema).repartition(7), keep, runs, fan_in)
        sorts = merged._jdf.queryExecution().executedPlan().toString()
        assert sorts.count("Sort [run#") == rounds
        found = {bytes(r.digest): (r.id, r.n) for r in merged.collect()}
        expected = {}
        for _, _, d, i, n, *_ in lines:
            ids, total = expected.get(d, ([], 0))
            expected[d] = (ids + [i] * (i is not None), total + n)
        assert found == {d: (pick(ids) if ids else None, n) for d, (ids, n) in expected.items()}


def test_a_digest_of_two_texts_stops_the_job(spark):
    lines = spark.createDataFrame([(0, 1, b"d", 1, 1, 5, 5, 7, 7), (1, 1, b"d", 2, 1, 5, 5, 8, 8)],
                                  "run long, slice long, digest binary, id long, n long, _len_lo int, _len_hi int, _sum_lo long, _sum_hi long")
    with pytest.raises(Exception, match="same SHA-256"):
        exact_dedup.merge_runs(lines).collect()


# --- 8 pieces --------------------------------------------------------------------------


def best_score(text, scores, unknown):
    best = {0: 0.0}
    for j in range(1, len(text) + 1):
        best[j] = max(best[i] + (scores[text[i:j]] if text[i:j] in scores else unknown if j - i == 1 else -math.inf) for i in range(j))
    return best[len(text)]


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(PIECES)


def encode(encoder, text):
    from array import array

    out = array("i")
    encoder.text(text, out)
    return list(out)


def test_paths_have_the_best_score():
    rng = random.Random(8)
    for _ in range(60):
        words = list({"".join(rng.choice("ab▁é") for _ in range(rng.randint(1, 4))) for _ in range(12)})
        scores = {w: -float(rng.randint(1, 9)) for w in words}
        base, check, value = pieces.double_array([w.encode() for w in words])
        small = {"base": base.tolist(), "check": check.tolist(), "value": value.tolist(), "ids": list(range(1, len(words) + 1)), "scores": [scores[w] for w in words],
                 "pieces": dict(enumerate(words, 1)), "bytes": {}, "unknown": 0, "cuts": False, "known": {}}
        encoder, lowest = pieces.Encoder(small), min(scores.values()) - pieces.UNKNOWN_PENALTY
        for _ in range(20):
            text = "".join(rng.choice("ab é") for _ in range(rng.randint(1, 12)))
            got = sum(scores[words[i - 1]] if i else lowest for i in encode(encoder, text))
            assert got == pytest.approx(best_score("▁" + text.replace(" ", "▁"), scores, lowest))


def test_cutting_texts_changes_no_path(model):
    rng, whole = random.Random(4), pieces.Encoder(model | {"cuts": False, "known": {}})
    cut = pieces.Encoder(model)
    for _ in range(200):
        text = random_text(rng, 40)
        assert encode(cut, text) == encode(whole, text)


def test_decoding_gives_texts_back_and_equals_the_library(model):
    import sentencepiece

    library, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), random.Random(6)
    encoder, decoder = pieces.Encoder(model), pieces.Decoder(model)
    for _ in range(500):
        text = random_text(rng)
        assert decoder.ids(encode(encoder, text)) == text
        ids = [rng.randrange(3, 32_000) if rng.random() < 0.5 else rng.randint(3, 258) for _ in range(rng.randint(0, 8))]
        assert decoder.ids(ids) == library.decode(ids)


def test_piece_columns(spark, model):
    rows = [(1, None), (2, ""), (None, " two  spaces "), (3, "a▁b"), (4, "word " * 100_000), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    ids = docs.select("doc_id", "text", pieces.encoded(F.col("text"), model, spark).alias("p"))
    back = ids.select("doc_id", "text", "p", pieces.decoded(F.col("p"), model, spark).alias("back")).collect()
    assert all(r.back == (r.text or "").replace("▁", " ") for r in back)
    assert ids.limit(0).isEmpty()
    found = docs.select("text", pieces.checked(F.col("text"), model, spark).alias("c")).select("text", "c.*").collect()
    assert {r.text: r.round_trip for r in found if r.text and "▁" in r.text} == {"a▁b": False}
    assert sorted(len(r.p) for r in back) == sorted(r.n_pieces for r in found)


# --- 9 quality ----------------------------------------------------------------------


def test_quality_of_held_out_documents(spark):
    df = quality_vote.query(spark, "/root/testdata/sf0.01")
    found = df.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in found) / len(found) > 0.95
    good = [r.score for r in found if r.quality == 1]
    poor = [r.score for r in found if r.quality == 0]
    assert np.mean([g > p for g in good for p in poor]) > 0.95


def test_quality_at_the_edges(spark):
    texts = [(i, f"plain words number{i} and more of them here", 1) for i in range(30)] + [(100 + i, f"BUY!! NOW{i}!! CHEAP!! " * 3, 0) for i in range(30)]
    odd = [(500, None, 1), (501, "", 0), (None, "plain words", 1), (502, "plain words here " * 50_000, None), (500, None, 1)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts + odd], "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, y) for i, _, y in texts + odd] + [(9999, 1), (3, 1)], "doc_id long, quality int")
    model = quality_vote.fit(docs, labels, F.lit(True))
    scores = {r.doc_id: r.s for r in docs.select("doc_id", quality_vote.scored(F.col("text"), model, spark).alias("s")).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    assert scores[3] > 0.8 and scores[103] < 0.2 and scores[501] == pytest.approx(model["prior"]) == pytest.approx(scores[500])
    nothing = quality_vote.fit(docs, labels.limit(0), F.lit(True))
    assert {r.s for r in docs.select(quality_vote.scored(F.col("text"), nothing, spark).alias("s")).collect()} == {0.5}
    assert docs.limit(0).select(quality_vote.scored(F.col("text"), model, spark)).isEmpty()


# --- 10 lines -----------------------------------------------------------------------


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, times, letters):
    out = list(text)
    for _ in range(times):
        at, what = rng.randrange(len(out) + 1), rng.randrange(3)
        if what == 0:
            out.insert(at, rng.choice(letters))
        elif out and what == 1:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = rng.choice(letters)
    return "".join(out)


def test_banded_distance_equals_the_table():
    rng = random.Random(10)
    for _ in range(6000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
        b, k = edited(rng, a, rng.randint(0, 5), "abc"), rng.randint(0, 3)
        assert line_dedup.within(a, b, k) == (edits(a, b) <= k), (a, b, k)


def test_every_pair_within_reach_shares_a_key():
    rng = random.Random(11)
    for _ in range(4000):
        a = "".join(rng.choice("ab ") for _ in range(rng.randint(26, 60)))
        b = edited(rng, a, rng.randint(1, 2), "ab ")
        short, long = sorted((a, b), key=len)
        assert set(line_dedup.index_keys(short)) & set(line_dedup.probe_keys(long))


def check_lines(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit("clash")).withColumn("id", F.lit(-1))
    found = {(r.doc_id, r.line_no): (r.class_id, r.class_line, r.kept) for r in line_dedup.duplicate_lines(docs).collect()}
    places = {}
    for i, text in rows:
        for n, line in enumerate(text.split("\n") if text is not None else []):
            if line.strip(" "):
                places.setdefault(line, []).append((i is None, i, n))
    order = sorted(places, key=lambda line: min(places[line]))
    links = [(p, q) for p, a in enumerate(order) for q, b in enumerate(order[p + 1 :], p + 1)
             if min(len(a), len(b)) >= line_dedup.LEAST_CHARS and abs(len(a) - len(b)) <= 2 and line_dedup.within(a, b)]
    group = closed(links, range(len(order)))
    expected = {}
    for p, line in enumerate(order):
        _, i, n = min(places[order[group[p]]])
        expected |= {place[1:]: (i, n, place[1:] == (i, n)) for place in places[line]}
    assert found == expected


def test_duplicate_lines_equal_brute_force(spark, sf):
    check_lines(spark, [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(80).collect()])


def test_duplicate_lines_at_the_edges(spark, monkeypatch):
    rng = random.Random(12)
    base = "a line that very many documents hold in slightly other words"
    # One large bucket: variants of one line; and two lines that share their first segment only.
    variants = [edited(rng, base, rng.randint(0, 6), "xyz") for _ in range(150)]
    rows = [(i, f"{v}\n\n  \nshort {i % 3}\nown line of document number {i * 7919}, long enough") for i, v in enumerate(variants)]
    rows += [(900, None), (901, ""), (None, base + "\nno identifier but a line of its own"), (902, "word " * 30_000), (903, "word " * 30_000 + "!"), (904, "é" * 30 + "\n" + "é" * 29 + "e")]
    check_lines(spark, rows)
    assert line_dedup.duplicate_lines(spark.createDataFrame([], "doc_id long, text string")).isEmpty()


def test_short_lines_equal_brute_force(spark):
    rng, lines = random.Random(13), ["The thertion.", "The, thertion.", "tiny line a", "tiny line b", "x" * 24, "x" * 23 + "y", "x" * 22 + "y", "x" * 20 + "zz"]
    for length in range(9, 27):
        base = "".join(rng.choice("abc ") for _ in range(length - 1)) + "."
        lines += [base, *(edited(rng, base, times, "abc") + "." for times in (0, 1, 1, 2, 2))]
    lines = [line for line in dict.fromkeys(lines) if line.strip(" ")]
    rng.shuffle(lines)

    def near(a, b):
        shorter = min(len(a), len(b))
        return edits(a, b) <= (2 if shorter >= 24 else 1 if shorter >= 12 else 0)

    group = closed([(p, q) for p, a in enumerate(lines) for q in range(p) if near(a, lines[q])], range(len(lines)))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in line_dedup.duplicate_lines(docs).collect()} == group
    assert group[lines.index("The thertion.")] == group[lines.index("The, thertion.")]
    assert group[lines.index("tiny line a")] != group[lines.index("tiny line b")]
    links = [(a, b) for a in lines for b in lines if a != b and len(a) <= len(b) and near(a, b)]
    assert all(set(line_dedup.index_keys(a)) & set(line_dedup.probe_keys(b)) for a, b in links)


def test_documents_without_duplicate_lines(spark):
    rows = [(1, "first line of some length here\nsecond\n\nsecond", "x"), (2, "first line of some length herE\nthird", None), (3, None, "z"), (None, "second", "w"), (4, "", "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").withColumn("gone", F.lit(1))
    left = line_dedup.without_duplicates(docs)
    assert left.columns == docs.columns
    assert {r.doc_id: (r.text, r.row) for r in left.collect()} == {
        1: ("first line of some length here\nsecond\n", "x"), 2: ("third", None), 3: (None, "z"), None: ("", "w"), 4: ("", "v")}


def test_models_are_read_within_bounds(monkeypatch):
    monkeypatch.setattr(token_count, "LARGEST_MODEL", 10)
    with pytest.raises(ValueError):
        token_count.read_model(BPE)
