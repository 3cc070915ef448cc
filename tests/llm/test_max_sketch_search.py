import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import docs, prose
from pyspark.sql import functions as F

from stellate.llm import max_sketch_search as M
from stellate.llm.max_sketch_search import ranked_search


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(M.TERM, low)


def brute(rows, items, k=50):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows]
    n_docs, n_all = sum(n > 0 for *_, n in bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
    own = {}
    for i, t in items:
        own.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in own.items():
        found = []
        for i, bag, n in bags:
            m = 50 + 50 * n * n_docs // max(1, n_all)
            score = sum(w[t] * (10**9 * bag[t] // (1000 * bag[t] + 20 * m)) for t in ts if t in bag)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        found.sort(key=lambda x: x[:3])
        out += [(item, r, i, -s) for r, (s, *_, i) in enumerate(found[:k], 1)]
    return out


def tables(seed=3):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.choice([1, 5, 40, 200]), 120)) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " .,! "), (203, prose(rng, 6000, 3000)), (204, "Ünïcode ÜNÏCODE w1 w2'w3_w4"), (None, rows[7][1])]
    rows += [(5, rows[5][1])] * 3 + [(300 + i, "w1 w2 w3") for i in range(40)]
    items = [(1, "w1 w2 w3 w3 Ünïcode"), (2, prose(rng, 30, 120)), (2, "w7 w8"), (3, None), (4, ""), (5, "nowhere"), (None, "w9 W10"),
             (6, rows[203 - 50][1] if len(rows) > 203 - 50 else "w1"), (7, prose(rng, 80, 3000)), (8, "w1")]
    return rows, items


def item_table(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("width", [1, 64, M.WIDTH])
def test_equals_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(M, "BOUNDS_AT_ONCE", 300)
    rows, items = tables()
    df = docs(spark, rows, clashes=True).repartition(9)
    its = item_table(spark, items).withColumn("score", F.lit("x")).withColumn("term", F.lit("y"))
    got = sorted(map(tuple, ranked_search(df, its, k=12, width=width).collect()), key=str)
    assert got == sorted(brute(rows, items, 12), key=str)


def test_blocks_and_empty(spark):
    rows, items = tables(4)
    got = sorted(map(tuple, ranked_search(docs(spark, rows), item_table(spark, items), block_terms=40).collect()), key=str)
    assert got == sorted(brute(rows, items), key=str)
    assert ranked_search(docs(spark, []), item_table(spark, items)).collect() == []
    assert ranked_search(docs(spark, rows), item_table(spark, [])).collect() == []
    assert ranked_search(docs(spark, [(1, None), (2, "..")]), item_table(spark, items)).collect() == []


def test_bounds_hold_and_save_work():
    """No exact score is above its bound, and rescoring stops before all pairs are scored."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = [" ".join(rng.choices(vocabulary, k=rng.randrange(5, 120))) for _ in range(600)]
    wanted = [rng.choices(vocabulary, k=12) for _ in range(5)]
    rows += [" ".join(w) for w in wanted for _ in range(3)]
    names = sorted({t for w in wanted for t in w})
    of = {t: i for i, t in enumerate(names)}
    pairs = sorted({(q, of[t]) for q, w in enumerate(wanted) for t in w})
    items = M.Items(list(range(5)), np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]), len(names),
                    np.array([M.xxhash.xxh64_intdigest(t.encode()) % 512 for t in names]))
    source = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows)], ["doc_id", "text"])
    index = pa.Table.from_batches(M._index_rows([source], {t.encode(): i + 1 for t, i in of.items()}, 512)).to_batches()[0]
    n_all = sum(index.column("n").to_pylist())
    df = np.bincount(np.concatenate([np.array(x, np.int64) for x in index.column("terms").to_pylist()]), minlength=len(names))
    items.weigh(len(rows), df)
    batch = M._Batch(index, 0, index.num_rows, len(rows), n_all)
    bounds = batch.bounds(*items.by_coordinate(512))
    d, q = np.divmod(np.arange(len(rows) * 5), 5)
    exact = batch.scores(items, d, q).reshape(-1, 5)
    assert (bounds >= exact).all()
    best = M.Best(np.ones(5, np.int64), 3)
    assert M.rescore(batch, items, bounds, best, at_once=8) < exact.size / 4
    for i in range(5):
        assert sorted(best.score[best.item == i]) == sorted(exact[:, i])[-3:]
