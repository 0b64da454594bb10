"""Exact duplicates, with DataFrame functions only.

Texts are grouped by their SHA-256 and by the text itself at every stage, so that equality never
rests on the digest:

1. each partition combines its own rows of a text (the partial aggregation before the shuffle);
2. these are merged within one of ``salts`` groups, chosen by partition, so that a text that holds
   a third of all rows meets in many tasks, each of which gets one row for each of its partitions;
3. the winners of the salts are combined to one row for each text.

Only then do rows find their group, by digest alone where stage 3 has seen a single text for it,
else by digest and text.

Defined results: a null text counts as empty. The largest ``doc_id`` of a text stays; null ids lose
to all others. Rows that repeat both id and text are one document, and say so alike. Columns other
than ``doc_id`` and ``text`` are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinloom.session import materialize

SALTS = 16


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def text_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """``digest, text, keep_id, group_size`` of each distinct text of ``doc_id, text, digest``."""
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "text", "salt")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    return (
        salted.repartition("digest").groupBy("digest", "text")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )


def exact_duplicates(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``."""
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("digest", text_digest(F.col("text")))
    winners = materialize(
        text_groups(rows, salts).groupBy("digest").agg(
            F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
            F.count("*").alias("texts"),
        ),
        "exact-winners",
    )
    plain = winners.filter("texts = 1").drop("texts")
    found = rows.select("doc_id", "digest").join(plain, "digest")
    shared = winners.filter("texts > 1").select("digest")
    if not shared.isEmpty():  # different texts of one digest
        apart = rows.join(shared, "digest", "left_semi")
        groups = text_groups(apart, salts)
        found = found.unionByName(apart.join(groups, ["digest", "text"]).drop("text"))
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_duplicates(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """``docs`` with one row for each text: that of the largest ``doc_id``.

    Of rows that repeat both id and text one is kept, whichever.
    """
    kept = exact_duplicates(docs, salts).filter("kept")
    kept = kept.select(F.col("doc_id").alias("_kept_id"), F.unhex("text_sha256").alias("_kept_text")).distinct()
    # The row travels as one column, out of the way of the operator's own.
    rows = docs.select(
        F.col("doc_id").cast("long"), text_digest(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_digest"),
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
    )
    same = rows["_digest"].eqNullSafe(kept["_kept_text"]) & rows["doc_id"].eqNullSafe(kept["_kept_id"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_digest"]).select("_row.*")
