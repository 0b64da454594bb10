"""Results of search requests as they arrive, until each request expires."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from twinloom.streaming.follow import _start

#: Requests whose counts make one group of state. A group costs some milliseconds in Python, however few its rows.
REQUESTS_A_GROUP = 4_000

KEPT = ["request_id", "in_time", "late", "ends_ms", "closes_ms"]
STATE = ", ".join(f"{name} array<long>" for name in KEPT)
FOUND = "request_id long, responded_at timestamp, result string, closed boolean, in_time long, late long"


def _counted(kept: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """One column of ``KEPT`` for each request: its counts added up, and its last times."""
    both = np.concatenate([kept, seen], axis=1)
    ids, place = np.unique(both[0], return_inverse=True)
    counted = np.empty((len(KEPT), len(ids)), "int64")
    counted[0] = ids
    counted[1], counted[2] = np.bincount(place, both[1]), np.bincount(place, both[2])
    counted[3:, place] = both[3:]
    return counted


def _take(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Passes on what came in time, counts the rest by request, and closes each request once it has expired.

    The timer of the group is that of its request that closes first.
    """
    now = state.getCurrentWatermarkMs()
    kept = np.array(state.get if state.exists else [[]] * len(KEPT), "int64")
    for rows in batches:
        if not len(rows):
            continue
        good = rows["timely"].astype(bool).to_numpy()
        if good.any():
            found = rows.loc[good, ["request_id", "responded_at", "result"]]
            yield found.assign(closed=False, in_time=0, late=0)
        ends = rows["ends_ms"].astype("int64").to_numpy()
        # A timer must lie ahead of the watermark; a request long expired closes with the next batch.
        kept = _counted(kept, np.stack([rows["request_id"].to_numpy(), good, ~good, ends, np.maximum(ends, now + 1)]))
    over = kept[4] < now
    if over.any():
        ids, in_time, late, ends, _ = kept[:, over]
        yield pd.DataFrame({
            "request_id": ids, "responded_at": pd.to_datetime(ends, unit="ms"), "result": "",
            "closed": True, "in_time": in_time, "late": late,
        })
    if over.all():
        state.remove()
    else:
        kept = kept[:, ~over]
        state.update(tuple(kept.tolist()))
        state.setTimeoutTimestamp(int(kept[4].min()))


def bounded(results: DataFrame, requests: DataFrame, delay: str = "10 days", groups: int = 8) -> DataFrame:
    """Results in time, and a closing row of counts for each request once it has expired.

    ``results``: a stream of ``request_id, responded_at, result``; ``requests``: a table of ``request_id,
    requested_at, expiry_seconds``. Nothing but two counts and a time is kept for a request, and a busy one is dealt
    to ``groups``, which close for themselves. ``delay`` is how late a result may arrive and still be seen.
    The state of many requests makes a group: as many groups as the requests need when the stream starts. A stream that goes on
    with more keeps the old ones, whose counts add up with the new.
    """
    ends = F.col("requested_at").cast("timestamp") + F.make_dt_interval(secs=F.col("expiry_seconds"))
    timed = requests.select(
        "request_id", F.col("requested_at").cast("timestamp").alias("starts"), ends.alias("ends")
    )
    timely: Column = (F.col("responded_at") >= F.col("starts")) & (F.col("responded_at") < F.col("ends"))
    request = F.col("request_id").cast("long")
    together = max(1, -(-requests.count() // REQUESTS_A_GROUP))
    seen = results.withWatermark("responded_at", delay).join(timed, "request_id").select(
        request.alias("request_id"),
        F.pmod(F.xxhash64(request), F.lit(together)).cast("int").alias("bucket"),
        F.pmod(F.xxhash64("result"), F.lit(groups)).cast("int").alias("part"),
        "responded_at", F.col("result").cast("string").alias("result"), timely.alias("timely"),
        F.unix_millis("ends").alias("ends_ms"),
    )
    return seen.groupBy("bucket", "part").applyInPandasWithState(
        _take, FOUND, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def start_bounded(
    results: DataFrame, requests: DataFrame, out: str, checkpoint: str, interval: str | None = None,
    delay: str = "10 days",
) -> StreamingQuery:
    """Write what ``bounded`` gives to ``out``, each row exactly once, also over restarts."""
    writer = bounded(results, requests, delay).writeStream.format("parquet").option("path", out)
    return _start(writer.outputMode("append").option("checkpointLocation", checkpoint), interval)


def read_results(spark: SparkSession, out: str) -> DataFrame:
    """``request_id, responded_at, result`` of the results that came in time."""
    return spark.read.parquet(out).where("not closed").select("request_id", "responded_at", "result")


def read_closed(spark: SparkSession, out: str) -> DataFrame:
    """``request_id, in_time, late`` of the requests that have expired."""
    closed = spark.read.parquet(out).where("closed")
    return closed.groupBy("request_id").agg(F.sum("in_time").alias("in_time"), F.sum("late").alias("late"))
