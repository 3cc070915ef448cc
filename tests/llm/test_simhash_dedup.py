import random
import re

import pytest
import xxhash
from cases import docs, prose

from pyspark.sql import functions as F

from stellate.llm import simhash_dedup
from stellate.llm.components import star_components
from stellate.llm.simhash_dedup import fingerprints, simhash_groups


def fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps, distance):
    """fps: {name: fingerprint}; the least name reachable from each."""
    names, up = sorted(fps), {n: n for n in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(names):
        for b in names[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {n: find(n) for n in names}


def test_fingerprints_match_definition():
    import pyarrow as pa
    rng = random.Random(3)
    texts = [None, "", " \t\n", "One", "One two", "A b C", "a b c a b c a b c", "é \x1c x　y", "ÀÉ B"] + [
        prose(rng, rng.randrange(1, 80), 30) for _ in range(60)]
    assert fingerprints(pa.array(texts)).tolist() == [fingerprint(t) for t in texts]


def near_copies(rng):
    rows, i = [], 0
    for _ in range(6):
        base = prose(rng, 120).split()
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = "x" + str(rng.randrange(9))
            rows.append((i, " ".join(w)))
            i += 1
    rows += [(i + k, prose(rng, rng.randrange(0, 40))) for k in range(30)]
    rows += [(900, None), (901, ""), (902, "Two words"), (903, "two  WORDS"), (5, rows[5][1]), (None, rows[7][1])]
    return rows


@pytest.mark.parametrize("most", [1, 32])
@pytest.mark.parametrize("distance", [2, 3])
def test_groups_match_brute_force(spark, most, distance):
    """Every variant crowded (most=1) or none: the same components."""
    rows = near_copies(random.Random(7))
    out = simhash_groups(docs(spark, rows, clashes=True), max_distance=distance, most_in_variant=most).collect()
    fps = {}
    for n, (_, t) in enumerate(rows):
        fps.setdefault(fingerprint(t), []).append(n)
    comp = components({f: f for f in fps}, distance)
    least = {}
    for f, rs in fps.items():
        for r in rs:
            if rows[r][0] is not None:
                least[comp[f]] = min(least.get(comp[f], 1 << 60), rows[r][0])
    want = sorted(((-1 if i is None else i), f"{fingerprint(t):016x}", least[comp[fingerprint(t)]]) for i, t in rows)
    assert sorted(((-1 if r.doc_id is None else r.doc_id), r.fingerprint, r.component_id) for r in out) == want
    assert len({r[2] for r in want}) < len(want) - 20


def test_crowded_variants_chain(spark):
    """A crowd of fingerprints a bit apart from each other is one component."""
    from stellate.llm.simhash_dedup import _links
    rng = random.Random(1)
    fps, x = set(), rng.getrandbits(63)
    while len(fps) < 300:
        fps.add(x)
        x ^= 1 << rng.randrange(20)
    far = {rng.getrandbits(63) for _ in range(300)}
    df = spark.createDataFrame([(f,) for f in fps | far], "fp bigint")
    for most in (4, 10_000):
        links = {(r.u, r.v) for r in _links(df, 2, most).collect()}
        assert all((u ^ v).bit_count() <= 2 for u, v in links)
        roots = {r.node: r.root for r in star_components(_links(df, 2, most), "t").collect()}
        assert {n: roots.get(n, n) for n in fps | far} == components({f: f for f in fps | far}, 2)


def test_long_chain_and_hub(spark):
    links = [(i, i + 1) for i in range(1, 200)] + [(500, i) for i in range(501, 900)]
    df = spark.createDataFrame(links, "u bigint, v bigint")
    roots = {r.node: r.root for r in star_components(df, "t").collect()}
    assert roots == {**{i: 1 for i in range(2, 201)}, **{i: 500 for i in range(501, 900)}}


def test_empty_table(spark):
    assert simhash_groups(docs(spark, [])).collect() == []


def test_variants_are_made_by_all_tasks(spark):
    """A small table of fingerprints, just grouped by them, is still dealt to as many tasks as a shuffle has."""
    fps = spark.range(3000).select(F.xxhash64("id").alias("fp")).groupBy("fp").agg(F.min(F.lit(1)).alias("doc"))
    seen = []

    def links(dealt, *_):
        seen.append(dealt.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect())
        return dealt.select(F.col("fp").alias("u"), F.col("fp").alias("v"))
    simhash_dedup._links, kept = links, simhash_dedup._links
    try:
        simhash_dedup._rooted(fps, 2, 32)
    finally:
        simhash_dedup._links = kept
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(seen[0]) == n and max(r["count"] for r in seen[0]) < 2 * 3000 / n
