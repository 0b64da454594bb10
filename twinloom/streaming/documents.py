"""Publishing, upserting and describing documents as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from twinloom.operators import describe as describing, jsonld, publish as publishing
from twinloom.operators.upsert import append_versions, build_twins
from twinloom.sources.documents import explode_twins, parse_documents, parse_twins
from twinloom.streaming.follow import _start

Builder = Callable[[DataFrame], DataFrame]


def start_publish(
    docs: DataFrame, out: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Publish each arriving document (``doc_id, content``): one row per feed in ``out``."""
    rows = publishing.publish(parse_documents(docs))
    writer = rows.writeStream.format("parquet").option("path", out).outputMode("append")
    return _start(writer.option("checkpointLocation", checkpoint), interval)


def start_share(
    docs: DataFrame, feeds: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Write the shares of each arriving document to the table of feeds, each exactly once.

    A share occurs at the time of its micro-batch, which stays the same if the batch is run again.
    """
    published = publishing.publish(parse_documents(docs))
    shares = publishing.shares_of(published, F.current_timestamp())
    writer = shares.writeStream.format("parquet").option("path", feeds).partitionBy("feed_id")
    return _start(writer.outputMode("append").option("checkpointLocation", checkpoint), interval)


def twins_of_documents(seed: str, host_id: str) -> Builder:
    """How twin documents become twins."""
    return lambda docs: build_twins(parse_twins(docs), seed, host_id)


def twins_of_linked_documents(seed: str, host_id: str, default_allow_list: str) -> Builder:
    """How flat JSON-LD documents become twins."""
    return lambda docs: jsonld.build_twins(jsonld.to_quads(docs), seed, host_id, default_allow_list)


def start_upsert(
    docs: DataFrame, build: Builder, table: str, failures: str, checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Build a twin from each arriving document (``content, batch``) and add it to the versions in ``table``.

    ``batch`` tells which of two documents of a twin is the later, whenever they arrive. A micro-batch
    that is run again after a failure changes nothing. Runs are merged by size as they come.
    """
    def write_batch(batch: DataFrame, number: int) -> None:
        built = build(batch).persist()
        good = built.where(F.col("error").isNull())
        append_versions(good.select("host_id", "twin_id", "properties", "feeds", "inputs", "batch"), table, number=number)
        bad = built.where(F.col("error").isNotNull()).select("content", "error")
        bad.write.mode("overwrite").parquet(f"{failures}/batch={number}")
        built.unpersist()

    writer = docs.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _start(writer, interval)


def start_describe(
    docs: DataFrame, twins: DataFrame, out: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Describe each twin of the arriving documents (``doc_id, content``) from the table ``twins``."""
    def write_batch(batch: DataFrame, number: int) -> None:
        asked = explode_twins(parse_documents(batch)).select(
            F.concat_ws("/", "doc_id", "twin_pos").alias("request_id"), "twin"
        )
        described = describing.describe(asked, twins).drop("described")
        described.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = docs.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _start(writer, interval)
