"""Following feeds as a stream.

Every query keeps its progress in its checkpoint folder: started again after a stop or a failure
it goes on where it was, which is how a lost connection is followed again. No watermark is set, as
it would drop shares that come late; shares are passed on one by one and need no state.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from twinloom import sizing
from twinloom.operators.follow import FEED, follow, last_stored, moment, snapshot


def _start(writer: DataStreamWriter, interval: str | None) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_follow(
    shares: DataFrame, interests: DataFrame, out: str, checkpoint: str, interval: str | None = None,
    counts: DataFrame | None = None,
) -> StreamingQuery:
    """Write each arriving share of a followed feed to ``out``, once per follower.

    Runs until stopped with an ``interval``; without one it takes what is there and ends.
    ``interests`` must be a stored table, as each micro-batch reads it. ``counts`` (``feed_counts`` of earlier
    shares) tell which feeds to split where there are too many interests to be broadcast.
    """
    followed = follow(shares, interests, sizing.fits(interests), counts)
    writer = followed.writeStream.format("parquet").option("path", out)
    return _start(writer.outputMode("append").option("checkpointLocation", checkpoint), interval)


def start_follow_from_snapshot(
    live: DataFrame, stored: DataFrame, interests: DataFrame, until: datetime, out: str,
    checkpoint: str, interval: str | None = None,
) -> StreamingQuery:
    """The last stored share of each feed first, then every share after ``until``.

    ``stored`` is the table of shares, ``live`` the stream of the same files, so that its first
    micro-batch comes as soon as anything is stored. The bound ``until`` parts them, so
    that no share is lost or repeated. Each micro-batch replaces its own folder of ``out``: run
    again after a failure it leaves the same rows.
    """
    small = sizing.fits(interests)
    bound = F.lit(until)

    def write_batch(batch: DataFrame, number: int) -> None:
        rows = follow(batch.where(F.col("occurred_at") > bound), interests, small)
        rows = rows.withColumn("phase", F.lit("live"))
        if number == 0:
            first = snapshot(stored, interests, bound, small).withColumn("phase", F.lit("snapshot"))
            rows = rows.unionByName(first)
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = live.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _start(writer, interval)


def start_last_state(
    shares: DataFrame, out: str, checkpoint: str, interval: str | None = None,
    order: tuple[str, str] = ("occurred_at", "event_id"),
) -> StreamingQuery:
    """Keep the last share of each feed as the state of the query, one row a feed.

    Each micro-batch writes the feeds whose last share is a new one to its own folder of ``out``; run again it
    leaves the same rows. A share that comes late is older than the state and changes nothing.
    """
    rest = [c for c in shares.columns if c not in FEED]
    place = F.struct(moment(F.col(order[0]), F.col(order[1])).alias("moment"), F.xxhash64(*rest).alias("content"))
    last = shares.groupBy(*FEED).agg(F.max_by(F.struct(*rest), place).alias("s"))

    def write_batch(batch: DataFrame, number: int) -> None:
        rows = batch.select(*FEED, "s.*").select(*shares.columns)
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = last.writeStream.outputMode("update").foreachBatch(write_batch)
    return _start(writer.option("checkpointLocation", checkpoint), interval)


def read_last_state(spark: SparkSession, out: str) -> DataFrame:
    """The last share of each feed, as far as the stream has come."""
    return last_stored(spark.read.parquet(out).drop("batch"))
