"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from twinloom.session import materialize


def connected(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in ``links`` (``a, b``): the smallest id that links lead to.

    Each round takes the smallest label among the neighbours and then the label of that label,
    which halves the way to go. Joins meet one row per id on one side and sums combine before
    they shuffle, so an id with very many links is no bottleneck. Each round's labels are a table
    in the shared folder.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "component-links")
    labels = materialize(
        both.groupBy(F.col("a").alias("id"))
        .agg(F.min("b").alias("least")).select("id", F.least("id", "least").alias("component")),
        "component-labels",
    )
    while True:
        label_of = labels.select(F.col("id").alias("b"), F.col("component").alias("near"))
        least = both.join(label_of, "b").groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near"))
        stepped = labels.join(least, "id").select(
            "id", "component", F.least("component", "near").alias("step")
        )
        jump = labels.select(F.col("id").alias("step"), F.col("component").alias("jump"))
        moved = stepped.join(jump, "step").select(
            "id", F.least("step", "jump").alias("component"),
            (F.least("step", "jump") < F.col("component")).alias("moved"),
        )
        labels = materialize(moved, "component-labels")
        if labels.filter("moved").isEmpty():
            return labels.select("id", "component")
