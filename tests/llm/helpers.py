"""Rows that every operator has to take, and small texts."""

from __future__ import annotations

import random

from pyspark.sql import SparkSession, types as T

CLASHING = ["digest", "kept", "key", "component", "rate", "tokens", "label", "_label", "_posterior", "salt", "ids"]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *[T.StructField(name, T.StringType()) for name in CLASHING],
])


def documents(spark: SparkSession, rows: list[tuple]):
    """A table of documents with columns of clashing names; rows are (doc_id, text[, lang])."""
    full = [
        (r[0], r[1], r[2] if len(r) > 2 else None, None, None, *["x"] * len(CLASHING)) for r in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, words: int, alphabet: str = "abcdefgh") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 6))) for _ in range(words))


HARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (None, None), (6, "One"),
    (7, prose(1, 20_000)), (8, prose(1, 20_000) + " end"), (9, "x" * 100_000), (10, "é ß 中文 \U0001d4b3"),
]
