"""From raw documents to encoded training data, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twinloom.llm import stages
from twinloom.session import materialize

#: Each takes (spark, docs, sf_dir); all but the last return the columns of ``documents``.
STAGES = [
    ("language", stages.known_language),
    ("exact_dedup", stages.exact_dedup),
    ("near_dedup", stages.near_dedup),
    ("mixing", stages.mixing),
    ("pieces", stages.pieces),
]

#: Compression, MinHash and merges have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
