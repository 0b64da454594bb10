"""Top-k search against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from twinloom.llm import topk


def by_hand(rows, every, k):
    good = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for q, v in {(i, tuple(v)) for i, v in good if i % every == 0}:
        scores = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v)]
        found += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.2, (400, 8)).astype(np.float32)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    rows += [(1000 + k, rows[7][1]) for k in range(30)] + [rows[10]]  # ties and a repeated row
    rows += [(2000, None), (2001, []), (2010, [None] * 8), (2020, [math.nan] * 8), (2030, [math.inf] * 8)]
    rows += [(2040, [0.5, 0.5]), (2041, [0.5, -0.5]), (None, rows[0][1]), (2050, [0.0] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    small = topk.TopKConfig(block=64, group=16)
    found = topk.top_k(table, F.col("vec_id") % 10 == 0, small)
    assert sorted(map(tuple, found.collect())) == by_hand(rows, 10, 5)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 10 == 0).collect() == []


def test_reading_stops_early():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-3, 4, (512, 4)).astype(np.int64)
    vectors[5], vectors[9] = [90, 90, 90, 90], [80, 80, 80, 80]
    block = topk.Block(np.arange(512), vectors)
    (ids, scores), (others, _) = block.best(np.array([[1, 1, 1, 1], [-1, -1, -1, -1]]), np.array([-1, 7]), topk.TopKConfig(k=2))
    assert ids.tolist() == [5, 9] and scores.tolist() == [360, 320]
    want = sorted((int(vectors[i].sum()), i) for i in range(512) if i != 7)[:2]
    assert others.tolist() == [i for _, i in want]


def test_queries_of_one_id_with_alike_hashes(spark):
    rows = [(50, [-1.0]), (50, [-2.0]), (1, [0.5]), (2, [0.25]), (3, [-0.5])]
    assert hash((-1,)) == hash((-2,))
    table = spark.createDataFrame([(i, [x[0] / 256]) for i, x in rows], "vec_id long, embedding array<double>")
    found = topk.top_k(table, F.col("vec_id") % 50 == 0)
    assert found.count() == 6 and [r.rank for r in found.orderBy("rank").collect()] == [1, 1, 2, 2, 3, 3]
