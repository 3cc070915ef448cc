import hashlib
import random
import re

import numpy as np
import pytest
from cases import docs, prose
from pyspark.sql import functions as F

from stellate.llm.decontaminate import WuManber, find_contamination


def split(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items, window=10):
    out = []
    for i, t in rows:
        w = split(t)
        hit, found = set(), set()
        for name, text in items:
            p = split(text)
            m = min(window, len(p))
            for s in {tuple(p[k:k + m]) for k in range(len(p) - m + 1)} if m else ():
                for k in range(len(w) - m + 1):
                    if tuple(w[k:k + m]) == s:
                        hit.update(range(k, k + m))
                        found.add("null" if name is None else str(name))
        names = ",".join(sorted(found))
        out.append((-1 if i is None else i, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out)


def tables(rng):
    items = [(k, prose(rng, rng.randrange(8, 40))) for k in range(25)]
    items += [(30, "One"), (31, "two  words"), (32, ""), (33, None), (34, "..."), (35, items[0][1]), (None, "Ünï códe x y z"),
              (36, "a a a a a a a a a a a"), (4, prose(rng, 15)), (37, "a a")]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(0, 30))]
        for _ in range(rng.randrange(3)):
            p = (rng.choice(items)[1] or "").split()
            a, b = rng.randrange(0, 4), rng.randrange(0, 4)
            parts += [" ".join(p[a:len(p) - b]).upper(), prose(rng, rng.randrange(0, 20))]
        rows.append((i, rng.choice([" ", "\n", "-- ", "\x00"]).join(parts)))
    rows += [(90, None), (91, ""), (92, "a " * 900), (93, "ünï CÓDE ünï códe X y Z"), (94, "one"), (5, rows[5][1]),
             (6, rows[7][1]), (None, rows[8][1]), (95, prose(rng, 700) + " " + items[3][1])]
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_matches_brute_force(spark, block_bytes):
    """One broadcast block of items, or several."""
    rows, items = tables(random.Random(11))
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("words", F.lit(1))
    got = find_contamination(docs(spark, rows, clashes=True), bench, block_bytes=block_bytes).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                  for r in got) == brute(rows, items)
    assert sum(r.contaminated for r in got) > 20


@pytest.mark.parametrize("m", [1, 2, 3, 10])
def test_search_finds_every_occurrence(m):
    rng = np.random.default_rng(m)
    patterns = np.unique(rng.integers(1, 4, (12, m)), axis=0)
    text = rng.integers(0, 4, 5000)
    place, pattern = WuManber(patterns).find(text)
    want = {(k, p) for k in range(len(text) - m + 1) for p in range(len(patterns)) if (text[k:k + m] == patterns[p]).all()}
    assert set(zip(place.tolist(), pattern.tolist())) == want and len(place) == len(want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert find_contamination(docs(spark, []), none).collect() == []
    r = find_contamination(docs(spark, [(1, "a b")]), none).first()
    assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (2, 0, 0, False)
