import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from cases import docs, prose

from stellate.llm.periodic_runs import _repeated, document_runs, maximal_runs, periodic_runs
from stellate.llm.queries import op12_periodic_runs, periodic_tail
from stellate.llm.suffix_tree import SuffixTree


def brute(s, least=6, periods=4):
    n, out = len(s), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if s[i] == s[i + q]:
                a = i
                while i + q < n and s[i] == s[i + q]:
                    i += 1
                length = i + q - a
                own = s[a:a + length]
                if length >= max(least, periods * q) and all(
                        any(own[k] != own[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((a, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(n, seed=1):
    rng = random.Random(seed)
    for _ in range(n):
        k, size = rng.choice([1, 2, 2, 3, 5]), rng.randrange(1, 70)
        s = [rng.randrange(k) for _ in range(size)]
        if rng.random() < 0.6 and size > 6:
            a, p = rng.randrange(size), rng.randrange(1, size // 4 + 1)
            s = s[:a] + [s[min(a + i % p, size - 1)] for i in range(size - a)]
        yield s


def test_common_extensions():
    for s in sequences(60):
        s = s + [9]
        tree = SuffixTree(np.array(s))
        order = sorted(range(len(s)), key=lambda i: s[i:])
        assert [order[r] for r in range(len(s))] == np.argsort(tree.rank).tolist()
        i, j = np.nonzero(~np.eye(len(s), dtype=bool))
        want = [next(k for k in range(len(s)) if a + k >= len(s) or b + k >= len(s) or s[a + k] != s[b + k]) for a, b in zip(i, j)]
        assert tree.common(i, j).tolist() == want


@pytest.mark.parametrize("least,periods", [(6, 4), (2, 2), (3, 3)])
def test_maximal_runs(least, periods):
    for s in sequences(800, periods):
        x = np.array([7, *s, 8])
        assert [(a - 1, n, q) for a, n, q in maximal_runs(x, least, periods).tolist()] == brute(s, least, periods)


def test_words_that_are_left_out_are_in_no_run():
    for s in sequences(800, 9):
        code = np.array(s)
        kept = _repeated(code, np.zeros(len(s), int))
        assert [tuple(r) for r in document_runs(code, kept, 6, 4).tolist()] == brute(s)


def expected(doc_id, text, rewrite):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if rewrite and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute(w)
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    return w, runs, " ".join(x for i, x in enumerate(w) if i not in gone)


def hard_rows():
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(0, 160), 60)) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n\t"), (203, "a " * 50), (204, "a b " * 30 + "c"), (205, "x  y\nz " * 20 + "q " + "k " * 9),
             (206, "é ß é ß é ß é ß é ß"), (207, "a b a b a b a b a b a b c a b a b a b a b a b"), (None, "n u l l " * 12), (3, rows[3][1]),
             (208, "z " * 3000), (209, " ".join(f"u{i % 700}" for i in range(3500)))]
    return rows


@pytest.mark.parametrize("rewrite", [None, periodic_tail])
def test_documents(spark, rewrite):
    rows = hard_rows()
    got = periodic_runs(docs(spark, rows, clashes=True), rewrite=rewrite).collect()
    assert len(got) == len(rows)
    have = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got)
    want = []
    for i, t in rows:
        w, runs, left = expected(i, t, rewrite)
        want.append((str(i), len(w), runs, left))
    assert have == sorted(want)
    assert periodic_runs(docs(spark, [])).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(docs(spark, []), least_periods=3)


def test_query_digests(spark, tmp_path):
    rows = hard_rows()
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for r in op12_periodic_runs(spark, str(tmp_path)).collect():
        got.setdefault(str(r.doc_id), []).append(tuple(r)[1:])
    for i, t in rows:
        _, runs, left = expected(i, t, True)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        longest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join("%d,%d,%d\n" % r for r in runs), left)]
        assert (len(runs), *longest, *sha) in got[str(i)]
