"""Describe: stored twins looked up by host and id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinloom import model, sizing, vocab
from twinloom.operators.route import error_document
from twinloom.sources.documents import to_document, twin_struct


def describe_projection(twin: Column) -> Column:
    """Ids and properties; of feeds only id and ``storeLast``, of inputs only the id."""
    def ports(name: str, stored: bool) -> Column:
        return F.transform(
            twin[name],
            lambda p: F.struct(
                p["id"].alias("id"),
                F.array().cast(f"array<{model.PROPERTY}>").alias("properties"),
                (F.coalesce(p["storeLast"], F.lit(False)) if stored else F.lit(False)).alias("storeLast"),
                F.array().cast(f"array<{model.VALUE}>").alias("values"),
            ),
        ).alias(name)

    return F.struct(
        twin["hostId"].alias("hostId"), twin["id"].alias("id"),
        twin["properties"].alias("properties"), ports("feeds", True), ports("inputs", False),
    )


def lookup_left(keys: DataFrame, stored: DataFrame, on: list[str]) -> DataFrame:
    """``keys`` left join ``stored``, without shuffling ``stored`` where the keys are few.

    An outer join cannot broadcast the side it preserves. So the distinct values of few keys are first
    sent to the stored rows, and only the hits are joined back, by the same columns. Rows of
    ``keys`` may repeat; nothing else of theirs is used.
    """
    wanted = keys.select(*on).distinct()
    if not sizing.fits(wanted):
        return keys.join(stored, on, "left")
    hits = stored.join(F.broadcast(wanted), on, "left_semi")
    return keys.join(hits, on, "left")


def describe(requests: DataFrame, twins: DataFrame) -> DataFrame:
    """``requests(request_id, twin)`` to one row each: route, error, document and the twin found.

    A twin that is unknown, or asked for without host or id, goes to failure with the input twin.
    """
    keyed = requests.select(
        "request_id", "twin", F.col("twin.hostId").alias("host_id"), F.col("twin.id").alias("twin_id")
    )
    stored = twins.select(
        "host_id", "twin_id", describe_projection(twin_struct()).alias("described")
    )
    error = (
        F.when(F.col("host_id").isNull(), F.lit(vocab.HOST_ID_MISSING))
        .when(F.col("twin_id").isNull(), F.lit(vocab.TWIN_ID_MISSING))
        .when(F.col("described").isNull(), F.lit(vocab.TWIN_UNKNOWN))
    )
    looked_up = lookup_left(keyed, stored, ["host_id", "twin_id"])
    routed = looked_up.withColumn("error", error)
    failed = F.col("error").isNotNull()
    return routed.select(
        "request_id", "host_id", "twin_id",
        F.when(failed, F.lit("failure")).otherwise(F.lit("success")).alias("route"), "error",
        F.when(failed, error_document(F.col("error"), F.col("twin")))
        .otherwise(to_document(F.col("described"))).alias("document"),
        "described",
    )
