"""Lines that many documents hold, with DataFrame functions only.

Texts are split at ``\\n``. The key of a line is the line without white space (``[\\x20\\x09-\\x0D]``)
at both ends, with A-Z lower-cased; only keys of ``min_chars`` code points or more are compared. Each key is hashed
(SHA-256), each hash counted once a document, and a key found in ``min_docs`` documents or more loses
its lines in all of them but those of the smallest ``doc_id`` that holds it. What stays is put together
again by position.

* Counting sends one row a hash and task. A row's hashes are made distinct within the row.
* A line that a third of all documents hold is one hash: its lines are dealt to as many groups as
  its count asks for (``sizing.weighted_join``), and meet only its one row there.
* Only positions travel back to the texts; a document's positions are never more than its lines.

Defined results: a null or empty text is one empty line. A row is a document; rows that share a
``doc_id`` lose or keep a line alike, and two such rows count twice. A null id comes after all others; rows
without id are told apart by their texts. Lines repeated within one document stay or go together.
Columns other than ``doc_id`` and ``text`` are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from twinloom import sizing
from twinloom.functions.lets import let
from twinloom.session import materialize

WHITE = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line stripped of white space and with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WHITE)), string.ascii_uppercase, string.ascii_lowercase)


def line_hashes(text: Column, min_chars: int) -> Column:
    """The hash of each line in order, as hex text; null for a key that is too short."""
    return F.transform(F.transform(lines_of(text), line_key), lambda key: F.when(
        F.length(key) >= min_chars, F.sha2(key, 256)
    ))


def _rows(docs: DataFrame) -> DataFrame:
    """``id, text, digest`` and ``row``, the other columns. The digest tells rows of one id apart; equal rows need not be."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"),
        F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row"),
    )


def repeated_lines(rows: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``hash, n, keep_id`` of each line of ``id, text`` found in ``min_docs`` documents or more."""
    hashes = F.array_distinct(F.array_compact(line_hashes(F.col("text"), min_chars)))
    lines = rows.select("id", F.explode(hashes).alias("hash")).select("id", F.unhex("hash").alias("hash"))
    counted = lines.groupBy("hash").agg(F.count("*").alias("n"), F.min("id").alias("keep_id"))
    return counted.where(F.col("n") >= min_docs)


def dropped_positions(rows: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``id, digest, gone``: the positions, from 0, of the lines that each document loses."""
    repeated = materialize(repeated_lines(rows, min_chars, min_docs), "repeated-lines")
    lines = rows.select(
        "id", "digest", F.posexplode(line_hashes(F.col("text"), min_chars)).alias("pos", "hash")
    ).where("hash is not null").select("id", "digest", "pos", F.unhex("hash").alias("hash"))
    heavy = sizing.heavy_keys(repeated.select("hash", "n"), ["hash"])
    met = sizing.weighted_join(lines, repeated.drop("n"), ["hash"], F.struct("id", "digest"), heavy)
    lost = met.where(~F.col("id").eqNullSafe(F.col("keep_id")))
    return lost.groupBy("id", "digest").agg(F.collect_set("pos").alias("gone"))


def with_kept_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``row`` (the other columns of ``docs``), ``id``, ``n_lines``, ``n_dropped`` and ``kept_text`` of every document."""
    rows = _rows(docs)
    gone = dropped_positions(rows.drop("row"), min_chars, min_docs).select(
        F.col("id").alias("_id"), F.col("digest").alias("_digest"), "gone"
    )
    same = rows["digest"].eqNullSafe(gone["_digest"]) & rows["id"].eqNullSafe(gone["_id"])

    def rest(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.array_join(F.transform(places, lambda at: F.get(lines, at)), "\n")

    return rows.join(gone, same, "left").select(
        "row", "id", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(let(lines_of(F.col("text")), rest)).alias("kept_text"),
    )


def line_report(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every row of ``docs``."""
    kept = with_kept_lines(docs.select("doc_id", "text"), min_chars, min_docs)
    return kept.select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def without_repeated_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``docs`` with the lines that stay as ``text``; no row goes, other columns are as they were."""
    kept = with_kept_lines(docs, min_chars, min_docs)
    return kept.select(*[
        F.col("kept_text").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns
    ])
