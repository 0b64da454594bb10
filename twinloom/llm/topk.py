"""Exact top-k by inner product: bounds at fixed depths of sorted lists, in blocks of vectors.

Vectors are dealt to blocks by their id, queries to groups; each block meets each group once. In a
block every component has its list of vectors, sorted by value. For a query all lists are read from
their best end, deeper and deeper. A vector's lower bound adds the list's last value for each
component not read yet, its upper bound the next value to be read. A vector is out once its upper
bound is below the k-th best lower bound; reading stops when hardly more than k are left to
all queries held together, and these get their final scores. Bounds are evaluated densely: at each of a few fixed depths the whole
block is multiplied by masks of what is read, which saves no products against full scores. Each block then sends k rows a query, from which the best are taken.

Defined results: components become floor(256 * x). Vectors that are null, empty, or hold a null or
non-finite component take no part, nor do rows without an id. Vectors meet only others of their
own length. Rows with the query's id are not its candidates. Rows that repeat a query's id and
vector are one query; repeated candidate rows each count. Ties go to the smaller id. Exact while
no sum of products reaches 2**53, beyond which bounds would round.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from twinloom.session import materialize

FOUND = "query_id long, vec_id long, score long"


@dataclass(frozen=True)
class TopKConfig:
    k: int = 5
    block: int = 4096
    group: int = 2048
    #: Shares of the lists after which bounds are compared.
    depths: tuple[float, ...] = (1 / 4, 1 / 2, 3 / 4, 7 / 8)
    #: Queries whose bounds are held at once.
    together: int = 256
    most_tasks: int = 20_000


def quantized(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that take part; components are floor(256 * x)."""
    x = F.col(column).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & (F.size(x) > 0) & finite)
    return rows.select(
        F.col("vec_id").cast("long"), F.transform(x, lambda v: F.floor(v * 256)).alias("vector")
    )


class Block:
    """Vectors of one block with a sorted list for each component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        rows, width = self.vectors.shape
        places = np.argsort(self.vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.vectors, places, axis=0)
        self.rank = np.empty_like(places, np.int32)
        np.put_along_axis(self.rank, places, np.arange(rows, dtype=np.int32)[:, None], axis=0)

    def best(
        self, queries: np.ndarray, owns: np.ndarray, config: TopKConfig
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the ``k`` best for each query, its own rows left out."""
        found = []
        for at in range(0, len(queries), config.together):
            found += self._best(queries[at : at + config.together], owns[at : at + config.together], config)
        return found

    def _best(self, queries: np.ndarray, owns: np.ndarray, config: TopKConfig) -> list:
        """All queries read their lists to the same depth; a list is read from above where the query is
        positive and from below where it is negative, so each bound is a product for either sign."""
        rows = len(self.ids)
        up, down = np.maximum(queries, 0).T.astype(float), np.minimum(queries, 0).T.astype(float)
        alive = self.ids[:, None] != owns[None, :]
        vectors = self.vectors.astype(float)
        for share in config.depths:
            if (alive.sum(axis=0) <= 4 * config.k).all():
                break
            depth = int(rows * share)
            high, low = (self.rank >= rows - depth), (self.rank < depth)  # what has been read
            parts = (vectors * high) @ up + (vectors * low) @ down
            above, below = (~high).astype(float), (~low).astype(float)
            first, last = self.sorted[0][:, None], self.sorted[-1][:, None]
            lower = parts + above @ (up * first) + below @ (down * last)
            following = self.sorted[rows - 1 - depth][:, None], self.sorted[depth][:, None]
            upper = parts + above @ (up * following[0]) + below @ (down * following[1])
            lower[~alive] = -np.inf
            if rows >= config.k:
                alive &= upper >= np.partition(lower, rows - config.k, axis=0)[rows - config.k]
        found = []
        for k, query in enumerate(queries):
            left = np.flatnonzero(alive[:, k])
            scores = self.vectors[left] @ query
            order = np.lexsort((self.ids[left], -scores))[: config.k]
            found.append((self.ids[left][order], scores[order]))
        return found


def top_k(
    vectors: DataFrame, is_query: Column, config: TopKConfig = TopKConfig(), column: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the best candidates of each row for which ``is_query`` holds."""
    # Numbered, as rows of one id may differ; stored, so that the numbers stay.
    asked = materialize(
        quantized(vectors.filter(is_query), column).distinct().withColumn("query", F.monotonically_increasing_id()),
        "top-k-queries",
    )
    rows = quantized(vectors, column)
    blocks = max(1, -(-rows.count() // config.block))
    groups = max(1, -(-asked.count() // config.group))

    def dealt(df: DataFrame, n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    width = F.size("vector").alias("width")
    one = rows.select("*", width, dealt(rows, blocks).alias("block")).withColumn("group", everywhere(groups))
    two = asked.select("*", width, dealt(asked, groups).alias("group")).withColumn("block", everywhere(blocks))

    def meet(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: dict[str, list] = {"query_id": [], "vec_id": [], "score": [], "query": []}
        if len(candidates) and len(queries):
            block = Block(candidates["vec_id"].to_numpy(), np.stack(candidates["vector"].to_numpy()))
            asked, owns = np.stack(queries["vector"].to_numpy()), queries["vec_id"].to_numpy()
            for own, number, (ids, scores) in zip(owns, queries["query"], block.best(asked, owns, config)):
                found["query_id"] += [int(own)] * len(ids)
                found["query"] += [int(number)] * len(ids)
                found["vec_id"] += ids.tolist()
                found["score"] += scores.tolist()
        return pd.DataFrame(found).astype("int64")

    keys = ["width", "block", "group"]
    # A meeting costs far more than its bytes tell, so tasks are not put together by size.
    tasks = min(blocks * groups, config.most_tasks)
    one, two = one.repartition(tasks, *keys), two.repartition(tasks, *keys)
    found = one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInPandas(meet, FOUND + ", query long")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= config.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
