"""Routes: where a row goes after a step, and what it says there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinloom.vocab import ROUTES


def error_document(error: Column, twin: Column | None = None) -> Column:
    """``{"error": …}``, or ``{"twin": …, "error": …}`` where the twin is known."""
    fields = [error.alias("error")]
    if twin is not None:
        fields.insert(0, twin.alias("twin"))
    return F.to_json(F.struct(*fields))


def with_route(df: DataFrame, error: str = "error") -> DataFrame:
    """Adds ``route``: ``failure`` for a row with an error, else ``success``."""
    return df.withColumn(
        "route", F.when(F.col(error).isNotNull(), F.lit("failure")).otherwise(F.lit("success"))
    )


def route_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("route").agg(F.count("*").alias("n"))


def split_routes(df: DataFrame) -> dict[str, DataFrame]:
    """One DataFrame per route; each reads only its own rows."""
    return {route: df.where(F.col("route") == route) for route in ROUTES}
