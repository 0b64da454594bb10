"""Clusters against a loop over integers."""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from twinloom.llm import clusters
from twinloom.llm.clusters import Centroids, ClusterConfig


def integers(vector, config):
    return [math.floor(config.scale * float(x)) for x in vector]


def takes_part(vector, config):
    return vector is not None and len(vector) == config.size and all(
        x is not None and math.isfinite(x) and -2**63 <= config.scale * float(x) < 2**63 for x in vector
    )


def nearest(v, centroids):
    return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))


def by_hand(rows, config):
    kept = [(i, integers(v, config)) for i, v in rows if takes_part(v, config)]
    hashed = lambda i: "g" if i is None else hashlib.sha256(f"{config.seed}:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (hashed(r[0]), r[1]))[:config.clusters]]
    for _ in range(config.rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v, centroids)[1], []).append(v)
        for k, members in groups.items():
            centroids[k] = [sum(column) // len(members) for column in zip(*members)]
    found = [(i, *reversed(nearest(v, centroids))) for i, v in kept]
    long = lambda n: n if n < 2**63 else None

    def total(which):
        sizes = [d for _, k, d in found if which is None or k == which]
        return None if any(d >= 2**63 for d in sizes) else long(sum(sizes))

    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, k, long(d), total(k), total(None), digest[k]) for i, k, d in found], key=repr)


def rows_of(found):
    return sorted(map(tuple, found.collect()), key=repr)


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("cluster", F.lit("x"))


def grouped(seed, n, size, spread=0.05):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 0.3, (6, size))
    return [[float(np.float32(x)) for x in middles[k % 6] + rng.normal(0, spread, size)] for k in range(n)]


def test_against_a_loop(spark):
    config = ClusterConfig(clusters=5, rounds=4, size=12, leading=4)
    rows = list(enumerate(grouped(1, 300, 12)))
    rows += [(1000 + k, rows[7][1]) for k in range(60)] + [rows[3], (3, rows[8][1]), (None, rows[5][1])]
    rows += [(2000, None), (2001, []), (2002, [0.5] * 11), (2003, [0.5] * 13), (2004, [None] * 12)]
    rows += [(2005, [math.nan] * 12), (2006, [math.inf] * 12), (2007, [-math.inf] + [0.0] * 11), (2008, [0.0] * 12)]
    assert rows_of(clusters.clusters(table(spark, rows).repartition(5), config)) == by_hand(rows, config)


def test_the_query_s_own_numbers(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in given.collect()][:150]
    config = ClusterConfig()
    assert rows_of(clusters.clusters(table(spark, rows))) == by_hand(rows, config)


def test_ties_copies_and_few_vectors(spark):
    config = ClusterConfig(clusters=4, rounds=3, size=3, leading=2)
    same = [(k, [0.25, 0.5, -0.5]) for k in range(40)]
    assert rows_of(clusters.clusters(table(spark, same), config)) == by_hand(same, config)
    grid = [(k, [k % 3 - 1.0, k // 3 % 3 - 1.0, 0.0]) for k in range(9)]
    assert rows_of(clusters.clusters(table(spark, grid), config)) == by_hand(grid, config)
    for few in (same[:1], grid[:2], []):
        assert rows_of(clusters.clusters(table(spark, few), config)) == by_hand(few, config)


def test_numbers_beyond_64_bits(spark):
    config = ClusterConfig(clusters=3, rounds=2, size=4, leading=2)
    rows = [(k, [float(k), -float(k) * 2.0**40, 2.0**52 + k, -(2.0**52)]) for k in range(12)]
    rows += [(20, [2.0**53, 0.0, 0.0, 0.0]), (21, [1e300, 0.0, 0.0, 0.0]), (22, [-1.0, 2.0**30, 0.0, 0.1])]
    assert rows_of(clusters.clusters(table(spark, rows, "double"), config)) == by_hand(rows, config)


def test_most_distances_are_ruled_out():
    vectors = np.array([integers(v, ClusterConfig()) for v in grouped(3, 600, 64)], dtype=np.int64)
    axes = np.linalg.svd(vectors - vectors.mean(axis=0))[2][:8].T
    leading = vectors @ axes
    residual = np.linalg.norm(vectors - leading @ axes.T, axis=1)
    centroids = Centroids(tuple(tuple(int(x) for x in v) for v in vectors[:6]), axes)
    chosen, least, measured = centroids.nearest(vectors, leading, residual)
    assert [(int(d), int(k)) for d, k in zip(least, chosen)] == [nearest(v.tolist(), centroids.vectors) for v in vectors]
    assert measured < 2 * len(vectors)
