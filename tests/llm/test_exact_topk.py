import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stellate.llm.exact_topk import Best, Postings, accumulate, exact_top_k

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, modulus=50, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    raw = {}
    for i, v, _ in rows:
        if i is not None and i % modulus == 0 and v is not None and all(x is not None and math.isfinite(x) for x in v):
            raw[i] = min(raw.get(i, list(v)), list(v))
    out = []
    for q, v in sorted(raw.items()):
        w = [math.floor(256 * x) for x in v]
        best = sorted((-sum(a * b for a, b in zip(w, c)), i) for i, c in ok if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


def vectors(rng):
    def vec():
        return [round(rng.choice([0.0, rng.uniform(-1, 1), rng.choice([-0.5, 0.5])]), 3) for _ in range(8)]
    rows = [(i, vec(), 0) for i in range(300)]
    rows += [(i, rows[7][1], 1) for i in range(300, 340)]                 # ties
    rows += [(400, None, 0), (401, [1.0, None], 0), (402, [float("nan")] * 8, 0), (450, [float("inf")] * 8, 0), (403, [], 0),
             (350, [], 0), (None, vec(), 0), (50, vec(), 0), (11, rows[11][1], 0), (500, [2.0, 3.0], 0), (404, [1.0] * 20, 0)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1024, 2])
def test_matches_brute_force(spark, block):
    rows = vectors(random.Random(3))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("id", F.lit(1)).repartition(3)
    got = sorted(map(tuple, exact_top_k(df, query_block=block).collect()))
    assert got == brute(rows)
    # groups of queries that are broadcast one after the other
    assert sorted(map(tuple, exact_top_k(df, query_block=block, broadcast_bytes=300).collect())) == got


def test_large_weights_are_exact():
    rng = np.random.default_rng(1)
    for top in (2**9, 2**20, 2**31):
        a, b = rng.integers(-top, top, (3, 6)), rng.integers(-top, top, (40, 6))
        b[rng.random(b.shape) < 0.3] = 0

        def postings(m):
            return Postings(*(x.ravel() for x in np.broadcast_arrays(np.arange(len(m))[:, None], np.arange(6)[None, :])), m.ravel())
        try:
            got = accumulate(postings(a), 3, postings(b), 40).tolist()
        except OverflowError:
            assert top == 2**31
            continue
        assert got == [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]


def test_too_large_score_raises(spark):
    df = spark.createDataFrame([(0, [2.0**40], 0), (1, [2.0**40], 0)], SCHEMA)
    with pytest.raises(Exception, match="64 bits"):
        exact_top_k(df).collect()


def test_ties_beyond_k():
    best = Best(np.array([0]), 3)
    best.add(np.array([9, 8, 7, 6, 5]), np.array([[4, 4, 4, 4, 4]]))
    best.add(np.array([1]), np.array([[4]]))
    assert best.row.tolist() == [1, 5, 6]


def test_few_rows(spark):
    assert exact_top_k(spark.createDataFrame([], SCHEMA)).collect() == []
    assert exact_top_k(spark.createDataFrame([(0, [1.0], 0)], SCHEMA)).collect() == []
    assert exact_top_k(spark.createDataFrame([(1, [1.0], 0), (2, [1.0], 0)], SCHEMA)).collect() == []
    assert [tuple(r) for r in exact_top_k(spark.createDataFrame([(0, [1.0], 0), (2, [1.0], 0)], SCHEMA)).collect()] == [(0, 1, 2, 65536)]
