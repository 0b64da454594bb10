"""The stages of the document pipeline: rows of ``documents`` in, those that go on out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from twinloom.llm import exact_dedup as exact, language, mixing as mix, near_dedup as near, pieces as piece
from twinloom.llm.queries import DOMAIN_WEIGHTS, PIECE_MODEL, domains_of, held_out, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; learned from four fifths of them."""
    learned = language.learn_dictionaries(docs.filter(~held_out()).select("text", "lang"))
    return docs.filter(~language.language_of(docs["text"], learned)["rejected"])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each text: the one of the largest ``doc_id``."""
    return exact.without_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest ``doc_id``."""
    gone = near.near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are most likely good, each once; others are thinned by a draw at their rate."""
    labels = domains_of(table(spark, sf_dir, "labels"))
    fit, _, posterior = mix.domain_rates(docs, labels, DOMAIN_WEIGHTS, keep="good")
    # The row travels as one column, out of the way of the operator's own.
    rows = docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    # Rows without an id are told apart by their texts.
    copies = mix.copies(fit.rate(F.col("_posterior")), F.col("doc_id"), F.sha2(F.col("text"), 256))
    often = posterior(rows).select("_row", copies.alias("_copies")).filter("_copies > 0")
    return often.select("_row", F.explode(F.sequence(F.lit(1), "_copies"))).select("_row.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encoded documents: ``doc_id, lang, source, ids, n_ids``."""
    return piece.encode_documents(docs, piece.read_model(PIECE_MODEL), ["doc_id", "lang", "source"])
