"""Labelled rows that the learning operators may use are used."""

from pyspark.sql import functions as F

from larder.llm import language_id, quality_vote


def test_no_language_is_lost_where_identifiers_repeat(spark):
    languages = ["de", "en", "es", "fr"]
    same_id = [(7, f"{lang} text {i}", lang) for lang in languages for i in range(2000)]
    alike = [(7, "all alike", "it")] * 1500
    unknown = [(None, f"sans identifiant {i % 3}", "nl") for i in range(900)]
    docs = spark.createDataFrame(same_id + alike + unknown, "doc_id long, text string, lang string")
    counts = {r["language"]: r["count"] for r in language_id._sample(docs, F.lit(True), "doc_id", "text", "lang").groupBy("language").count().collect()}
    assert set(counts) == {*languages, "it", "nl"}
    assert all(0 < n <= language_id.SAMPLE for n in counts.values()) and counts["it"] == language_id.SAMPLE
    assert all(counts[lang] >= 0.9 * language_id.SAMPLE for lang in languages)


def test_labels_of_absent_documents_take_no_places(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "doc_id long, text string")
    labels = spark.range(100_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    sample = quality_vote.labelled_sample(docs, labels, F.lit(True), "doc_id", "text", "quality")
    assert sample.count() == 500
    odd = spark.createDataFrame([(None, 1), (1, None), (1, 0), (2, 1), (2, 1)], "doc_id long, quality int")
    assert sorted((r.text, r.label) for r in quality_vote.labelled_sample(docs, odd, F.lit(True), "doc_id", "text", "quality").collect()) == [("text 1", 0.0), ("text 2", 1.0)]
