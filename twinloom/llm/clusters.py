"""Clusters around centroids, in exact integers, with most distances ruled out by a bound.

A component x of a vector counts as the integer ``floor(scale * x)``. Vectors are stored once, with their
``leading`` coordinates in the rotation of their principal axes and the norm of what these leave out. For
a vector and a centroid, the squared distance of the leading coordinates plus the squared difference of the
residual norms is never more than their squared distance. So each round takes the centroid of the
smallest bound, and then only those whose bound (less a slack for rounding) does not exceed the
distance to it; all of these are measured in integers. The rotation saves work and never changes a result.

Centroids are few numbers, kept on the driver and sent with each round; a round brings back the sums of each
cluster, added up by Spark. Means are exact floors; an empty cluster keeps its centroid.

Defined results: vectors that are null, have another number of components, or hold one that is null,
not finite, or too large for a long take no part. The first centroids are the vectors with the smallest
hash of ``seed:vec_id``, those without an id last, equal ids in the order of their vectors. Of equal distances the
smaller number wins. Rows that repeat each count. A distance or inertia that no long can hold is null.
With fewer vectors than clusters there are fewer clusters. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from twinloom.session import materialize

#: Components up to this leave room for a squared distance of thousands of components in 64 bits.
PLAIN = 1 << 25
LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class ClusterConfig:
    clusters: int = 8
    rounds: int = 10
    size: int = 64
    scale: int = 1024
    seed: int = 3
    leading: int = 16


@dataclass(frozen=True)
class Centroids:
    """Integer centroids, with their place in the rotation."""

    vectors: tuple[tuple[int, ...], ...]
    axes: np.ndarray  # a column for each leading axis, orthonormal

    def moved(self, to: dict[int, list[int]]) -> Centroids:
        return Centroids(tuple(tuple(to.get(k, v)) for k, v in enumerate(self.vectors)), self.axes)

    def digest(self, number: int) -> str:
        return hashlib.sha256(",".join(map(str, self.vectors[number])).encode()).hexdigest()

    def nearest(self, vectors: np.ndarray, leading: np.ndarray, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The number of each vector's centroid, its squared distance, and how many distances were measured."""
        plain = np.abs(vectors).max(initial=0) < PLAIN and all(abs(x) < PLAIN for c in self.vectors for x in c)
        kind = np.int64 if plain else object  # beyond, in integers of any size
        vectors, centroids = vectors.astype(kind), np.array(self.vectors, dtype=kind)

        def measure(rows: np.ndarray, number: int) -> np.ndarray:
            return ((vectors[rows] - centroids[number]) ** 2).sum(axis=1)

        places = centroids.astype(float) @ self.axes
        left = np.linalg.norm(centroids.astype(float) - places @ self.axes.T, axis=1)
        bound = ((leading[:, None, :] - places) ** 2).sum(axis=2) + (residual[:, None] - left) ** 2
        # What rounding may add to a bound grows with the vectors' own lengths.
        slack = 1e-9 * (((leading ** 2).sum(axis=1) + residual ** 2)[:, None] + (places ** 2).sum(axis=1) + left ** 2 + 1)
        rows = np.arange(len(vectors))
        chosen = bound.argmin(axis=1)
        least = np.zeros(len(vectors), dtype=kind)
        for number in range(len(centroids)):
            mine = rows[chosen == number]
            least[mine] = measure(mine, number)
        first, measured = chosen.copy(), len(vectors)
        for number in range(len(centroids)):
            open_rows = rows[(first != number) & ((bound[:, number] - slack[:, number]) <= least.astype(float) * (1 + 1e-12))]
            measured += len(open_rows)
            distance = measure(open_rows, number)
            known = least[open_rows]
            better = (distance < known) | ((distance == known) & (number < chosen[open_rows]))
            least[open_rows[better]], chosen[open_rows[better]] = distance[better], number
        return chosen, least, measured


# --- The stored vectors ---------------------------------------------------------


def integer_vectors(rows: DataFrame, config: ClusterConfig) -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * config.scale))
    limit = float(1 << 63)
    good = (F.size("embedding") == config.size) & F.forall("embedding", lambda x: F.coalesce(
        (x.cast("double") * config.scale >= -limit) & (x.cast("double") * config.scale < limit), F.lit(False)
    ))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(good).select(
        "vec_id", scaled.cast("array<long>").alias("v")
    )


def principal_axes(vectors: DataFrame, config: ClusterConfig) -> np.ndarray:
    """Orthonormal leading axes of all ``v``; the plain ones where there is nothing to learn from."""
    count = min(config.leading, config.size)
    if len(vectors.select("v").head(2)) < 2:
        return np.eye(config.size, count)
    model = PCA(k=count, inputCol="_v", outputCol="_pc").fit(
        vectors.select(array_to_vector(F.col("v").cast("array<double>")).alias("_v"))
    )
    axes = model.pc.toArray()
    return np.linalg.qr(axes)[0] if np.isfinite(axes).all() else np.eye(config.size, count)


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def rotated(axes: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``leading`` and ``residual`` to batches of ``vec_id, v``."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("v"), axes.shape[0], float)
            leading = vectors @ axes
            residual = np.linalg.norm(vectors - leading @ axes.T, axis=1)
            offsets = np.arange(len(leading) + 1, dtype=np.int32) * axes.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.ListArray.from_arrays(offsets, leading.ravel()), pa.array(residual)],
                names=["vec_id", "v", "leading", "residual"],
            )

    return of_batches


def _assigned(batch: pa.RecordBatch, centroids: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = _matrix(batch.column("v"), centroids.axes.shape[0], np.int64)
    leading = _matrix(batch.column("leading"), centroids.axes.shape[1], float)
    chosen, least, _ = centroids.nearest(vectors, leading, batch.column("residual").to_numpy())
    return vectors, chosen, least


# --- Rounds ---------------------------------------------------------------------


def cluster_sums(stored: DataFrame, centroids: Centroids) -> dict[int, list[int]]:
    """The mean, component by component as an exact floor, of each cluster that holds a vector."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = {}, {}
        for batch in batches:
            vectors, chosen, _ = _assigned(batch, centroids)
            small = np.abs(vectors).max(initial=0) < PLAIN
            for number in np.unique(chosen):
                mine = vectors[chosen == number]
                total = (mine if small else mine.astype(object)).sum(axis=0)
                sums[number] = [a + int(b) for a, b in zip(sums.get(number, [0] * len(total)), total)]
                counts[number] = counts.get(number, 0) + len(mine)
        if counts:
            numbers = sorted(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array([int(n) for n in numbers], pa.int32()), pa.array([counts[n] for n in numbers], pa.int64()),
                pa.array([[str(x) for x in sums[n]] for n in numbers], pa.list_(pa.string())),
            ], names=["cluster", "n", "sums"])

    parts = stored.mapInArrow(partial, "cluster int, n long, sums array<string>")
    totals = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    )
    means: dict[int, list[int]] = {}
    for row in totals.orderBy("cluster", "at").collect():  # a row for each component of each cluster
        means.setdefault(row["cluster"], []).append(int(row["total"]) // row["n"])
    return means


def first_vectors(stored: DataFrame, config: ClusterConfig) -> list[tuple[int, ...]]:
    hashed = F.sha2(F.concat(F.lit(f"{config.seed}:"), F.col("vec_id").cast("string")), 256)
    rows = stored.select(hashed.alias("hash"), "v").orderBy(F.asc_nulls_last("hash"), "v").limit(config.clusters)
    return [tuple(row["v"]) for row in rows.collect()]


def fit(rows: DataFrame, config: ClusterConfig = ClusterConfig()) -> tuple[DataFrame, Centroids]:
    """The stored vectors and the centroids after all rounds."""
    vectors = integer_vectors(rows, config)
    axes = principal_axes(vectors, config)
    stored = materialize(vectors.mapInArrow(
        rotated(axes), "vec_id long, v array<long>, leading array<double>, residual double"
    ), "cluster-vectors")
    centroids = Centroids(tuple(first_vectors(stored, config)), axes)
    for _ in range(config.rounds if centroids.vectors else 0):
        centroids = centroids.moved(cluster_sums(stored, centroids))
    return stored, centroids


def assign(stored: DataFrame, centroids: Centroids) -> DataFrame:
    """``vec_id, cluster, distance`` of every stored vector."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, chosen, least = _assigned(batch, centroids)
            distance = pa.array([int(x) if x <= LARGEST else None for x in least], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(chosen.astype(np.int32)), distance], names=["vec_id", "cluster", "distance"]
            )

    return stored.mapInArrow(of_batches, "vec_id long, cluster int, distance long")


def clusters(rows: DataFrame, config: ClusterConfig = ClusterConfig()) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector of ``vec_id, embedding``."""
    spark = rows.sparkSession
    stored, centroids = fit(rows, config)
    found = materialize(assign(stored, centroids), "clusters")
    total = F.sum(F.col("distance").cast("decimal(20,0)"))
    sums = {r["cluster"]: r for r in found.groupBy("cluster").agg(
        total.alias("total"), (F.count("distance") == F.count("*")).alias("whole")
    ).collect()}  # a row for each cluster

    def as_long(clusters: list[int]) -> int | None:
        if not all(sums[k]["whole"] for k in clusters):
            return None
        value = sum(int(sums[k]["total"]) for k in clusters)
        return value if value <= LARGEST else None

    known = [(k, as_long([k]), as_long(list(sums)), centroids.digest(k)) for k in sorted(sums)]
    table = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
