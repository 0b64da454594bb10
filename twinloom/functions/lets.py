"""Name a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` written and computed once however often it is used.

    A column added by ``withColumn`` does not give that: a filter on a later column is pushed
    below it, and every use then becomes a copy of its definition.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
