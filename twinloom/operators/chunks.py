"""Results that arrive in chunks, put together again."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from twinloom import vocab

CHUNKS_PER_SEGMENT = 512


def reassemble(chunks: DataFrame, key: str = "query_id", per_segment: int = CHUNKS_PER_SEGMENT) -> DataFrame:
    """``chunks(key, seq, last, chunk)`` to the text of each result, in the order of ``seq``.

    A result is a table of segments of ``per_segment`` chunks, numbered from 0 to ``n_segments`` - 1, so
    that no task ever holds more than one segment of it. A chunk that came several times counts
    once. Adds ``route`` and ``error``: a result is complete if its last chunk and every one before
    it have come with their content, numbered from 0, and none besides.
    """
    once = chunks.groupBy(key, "seq").agg(F.min("chunk").alias("chunk"), F.max("last").alias("last"))
    segment = F.expr(f"seq div {int(per_segment)}")
    parts = once.groupBy(key, segment.alias("segment")).agg(
        F.count("*").alias("n_chunks"),
        F.sort_array(F.collect_list(F.struct("seq", "chunk"))).alias("ordered"),
    )
    texts = parts.select(
        key, "segment", "n_chunks",
        F.array_join(F.transform("ordered", lambda c: c["chunk"]), "").alias("text"),
    )
    whole = (
        (F.max("seq") == F.max(F.when(F.col("last"), F.col("seq")))) & (F.min("seq") == 0)
        & (F.count("*") == F.max("seq") + 1) & (F.count("chunk") == F.count("*"))
    )
    results = once.groupBy(key).agg(
        F.coalesce(whole, F.lit(False)).alias("complete"),
        (F.expr(f"max(seq) div {int(per_segment)}") + 1).alias("n_segments"),
    )
    failed = ~F.col("complete")
    return texts.join(results, key).select(
        key, "segment", "n_segments", "n_chunks", "text",
        F.when(failed, F.lit("failure")).otherwise(F.lit("success")).alias("route"),
        F.when(failed, F.lit(vocab.CHUNKS_INCOMPLETE)).alias("error"),
    )
