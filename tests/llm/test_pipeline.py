"""The pipeline's stages one by one, its whole run, and the guard for a missing package."""

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from larder.llm import exact_dedup, line_dedup, queries
from larder.llm.common import table
from larder.session import materialize

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_are_those_asked_for():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "mix", "pieces"]
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_stages_keep_the_columns_of_documents(spark, sf):
    docs = table(spark, sf, "documents").limit(60).withColumn("extra", F.lit(None).cast("string"))
    odd = spark.createDataFrame([(None, None, None, None, None, "x"), (7001, "", "en", "s", 0, None)], docs.schema)
    docs = docs.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns, name
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).isEmpty(), name


def test_lines_and_groups_are_unique_after_their_stages(spark, sf):
    docs = table(spark, sf, "documents")
    before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    lines = corpus_pipeline.fresh_lines(spark, docs, sf).collect()
    assert len(lines) == docs.count()
    every = line_dedup.without_duplicates(docs).select("doc_id", "text").collect()
    seen = [line for r in every for line in (r.text or "").split("\n") if line.strip(" ")]
    assert len(seen) == len(set(seen))
    # Documents that would lose most of their text keep what an original has; none that had text is empty.
    strict = {r.doc_id: r.text for r in every}
    equal = {}
    for r in lines:
        assert equal.setdefault(before[r.doc_id], r.text) == r.text
        assert not (before[r.doc_id] or "").strip() or r.text.strip()
        whole, left = (sum(len(x) for x in (t or "").split("\n") if x.strip(" ")) for t in (before[r.doc_id], strict[r.doc_id]))
        if whole - left <= 0.5 * whole and list(before.values()).count(before[r.doc_id]) == 1:
            assert r.text == strict[r.doc_id]
    once = corpus_pipeline.one_of_each(spark, docs, sf)
    texts = [r.text for r in once.select("text").collect()]
    assert len(texts) == len(set(texts)) < docs.count()


def test_copies_are_dropped_and_not_emptied(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    direct = {r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, sf).select("doc_id").collect()}
    after = {r.doc_id for r in corpus_pipeline.one_of_each(spark, materialize(corpus_pipeline.fresh_lines(spark, docs, sf), "fresh"), sf).select("doc_id").collect()}
    copies = {r.doc_id for r in exact_dedup.exact_dedup(docs).where("NOT kept").select("doc_id").collect()}
    # Texts without words are linked with nothing; all other copies are dropped, with or without the stage before.
    assert len(copies - after) > 20 and copies & after == copies & direct


def test_run(spark, sf):
    found = entry_point.queries()["pipeline"](spark, sf).collect()
    assert found and all(r.n_pieces == len(r.pieces) for r in found)


def test_the_last_stage_decodes(spark, sf):
    rows = [(1, "en", "s", "plain words é😀"), (2, "en", "s", "a▁b"), (3, None, None, None), (4, "en", "s", "")]
    found = corpus_pipeline.encoded(spark, spark.createDataFrame(rows, "doc_id long, lang string, source string, text string"), sf).collect()
    # A marker in a text decodes to a space.
    assert {r.doc_id: r.round_trip for r in found} == {1: True, 2: False, 3: True, 4: True}
    assert {r.doc_id: len(r.pieces) == r.n_pieces for r in found} == dict.fromkeys([1, 2, 3, 4], True)


def test_entry_works_without_the_package(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op1_') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)


@pytest.mark.parametrize("broken", ["raise ImportError('no')", "import no_such_module"])
def test_other_import_errors_are_not_hidden(tmp_path, broken):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests"))
    (copy / "larder/llm/pieces.py").write_text(broken)
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True, timeout=120)
    assert done.returncode != 0
