import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as X

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score long"


def brute(rows):
    """Rows (vec_id, vector, label) in their stored order; equal results whatever the order of full ties."""
    kept = [(i, [math.floor(256 * x) for x in v], ((y + 1) % 10 if i is not None and i % 7 == 0 else y)) for i, v, y in rows
            if v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v, y) in enumerate(kept):
        if i is None or i % 50:
            continue
        others = sorted((-sum(p * q for p, q in zip(v, w, strict=False)), j is None, j or 0, b, z)
                        for b, (j, w, z) in enumerate(kept) if b != a)
        for s, none, j, _, z in [o for o in others if o[4] == y][:5]:
            found = [o for o in others if o[4] != y and 50 * -s <= 100 * -o[0] <= 95 * -s][:3]
            out += [(i, None if none else j, r, None if o[1] else o[2], -s, -o[0]) for r, o in enumerate(found, 1)]
    return sorted(out, key=repr)


def got(df, **settings):
    vec_id = F.col("vec_id")
    table = (df.withColumn("label", F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
             .where(X.usable(F.col("embedding"))).withColumn("embedding", X.quantised(F.col("embedding"))))
    return sorted((tuple(r) for r in X.mine(table, vec_id % 50 == 0, **settings).collect()), key=repr)


def table(n, width, seed, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) / 8 for _ in range(width)], rng.randrange(10)) for i in range(n)]


@pytest.mark.parametrize("width", [1, 3, 24])
def test_brute_force(spark, width):
    rows = table(700, width, width)
    df = spark.createDataFrame([(*r, "q", 0) for r in rows], SCHEMA).repartition(3)
    want = brute(rows)
    assert want and got(df, shard_rows=150, block_queries=4, leaf=16) == want


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = table(160, 4, 9)
    rows += [(None, [0.5, 0.5, 0.5, 0.5], 3), (None, None, 1), (200, [0.5, None, 0.1, 0.2], 1), (250, [float("nan"), 0.0, 1.0, 0.0], 2),
             (300, [float("inf"), 0.0, 0.0, 0.0], 2), (350, [0.1, 0.2, 0.3, 0.4], None), (400, [], 2), (450, [0.7, -0.1], 2), (-50, [0.3] * 4, 5),
             *[(1000 + i, [0.25] * 4, rng.randrange(3)) for i in range(60)]]          # copies of one vector
    df = spark.createDataFrame([(*r, "q", 0) for r in rows], SCHEMA).repartition(5)
    assert got(df, shard_rows=40, leaf=8) == brute(rows)
    assert got(df.limit(0)) == []
    assert got(df.where("vec_id = 50")) == []


def test_repeated_anchor_rows(spark):
    rows = table(120, 4, 2) + [(50, [0.1, 0.2, -0.3, 0.4], 1)] * 2
    df = spark.createDataFrame([(*r, "q", 0) for r in rows], SCHEMA).repartition(2)
    assert got(df, leaf=8) == brute(rows)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, [float(2 ** 24 + 2 * (i % 11)), float(2 ** 23 + i), -1.0], i % 3) for i in range(101)]
    df = spark.createDataFrame([(*r, "q", 0) for r in rows], SCHEMA)
    assert got(df, leaf=8) == brute(rows)


def test_boxes_bound_products_and_prune(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    vecs = np.floor(rng.normal(size=(600, 3)) * 50)
    leaves = [t for t in X._tiles(np.arange(600), vecs, 20, 1)]
    assert sorted(np.concatenate(leaves)) == list(range(600)) and max(map(len, leaves)) <= 20
    tree = pa.table({"row": [list(map(int, t)) for t in leaves], "id": [list(map(int, t)) for t in leaves],
                     "label": [[0] * len(t) for t in leaves], "vec": [vecs[t].tolist() for t in leaves]})
    shard = X.Shard(tree, 3)
    a = np.floor(rng.normal(size=(1, 3)) * 50)
    least, most = X._bounds(a, shard.lo, shard.hi)
    for i, t in enumerate(leaves):
        s = vecs[t] @ a[0]
        assert least[0, i] <= s.min() and s.max() <= most[0, i]
    seen = []
    exact = X._exact
    try:
        X._exact = lambda m, v, small: (seen.append(len(m)), exact(m, v, small))[1]
        found = X.search_shard(shard, a[0], -1, 0, True, 5, [(X.LONG.min, X.LONG.max, X.LONG.min)], least[0], most[0], True)[0]
    finally:
        X._exact = exact
    assert [-s for s, *_ in found] == sorted(vecs @ a[0], reverse=True)[:5]
    assert len(seen) < len(leaves) / 2          # most boxes were never opened
