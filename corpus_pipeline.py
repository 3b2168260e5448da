"""The corpus pipeline: from documents to piece identifiers of a mixed, deduplicated corpus.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the columns of
documents. Between stages the documents are written to the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import language_id, line_dedup, near_dedup, pieces, source_mix
from larder.llm.common import table, unpacked
from larder.session import materialize


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is rejected; learns from the documents' own labels."""
    return language_id.keep_known(docs)


# A document that would lose a larger share of its characters is a copy: it is left like its original to the stage that compares documents.
MOST_REMOVED = 0.5


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that repeat an earlier line, exactly or within two edits (one for short lines). Keeps every document.

    Copies are not emptied: equal texts lose the same lines, and a document that would lose more than ``MOST_REMOVED`` of its
    characters keeps those of the document it shares most with. No document that had text becomes empty. Null and empty texts
    stay as they are, and repeated rows stay alike.
    """
    return line_dedup.with_copies_whole(docs, MOST_REMOVED).withColumn("n_chars", F.char_length("text").cast("long"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest document of each group of near-duplicates, four fifths of whose shingles are common."""
    return near_dedup.keep_one(docs, similarity=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents to bring sources to their target weights, in shuffled order."""
    return unpacked(source_mix.replicate(docs, source_mix.WEIGHTS), docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece identifiers of every text, and whether they decode to it: doc_id, lang, source, n_pieces, pieces, round_trip."""
    import public_tokenizers

    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    found = docs.select("doc_id", "lang", "source", pieces.encoded_and_decoded(F.col("text"), model, spark).alias("found"))
    return found.select("doc_id", "lang", "source", F.size("found.pieces").alias("n_pieces"), "found.pieces", "found.round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", recognised),
    ("lines", fresh_lines),
    ("near_duplicates", one_of_each),
    ("mix", mixed),
    ("pieces", encoded),
]

# Training, components and Viterbi paths are beyond SQL: the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
