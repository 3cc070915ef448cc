import hashlib
import random
import re

import pytest
from cases import docs, prose

from stellate.llm.substring_dedup import COVER, PERIOD, check_cover, remove_repeats


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    ids = [(1 << 62) if i is None else i for i, _ in rows]
    for i, w in zip(ids, words):
        for k in range(len(w) - window + 1):
            s = tuple(w[k:k + window])
            first[s] = min(first.get(s, i), i)
    out = []
    for i, w, (raw, _) in zip(ids, words, rows):
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((-1 if raw is None else raw, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def corpus(rng):
    passages = [prose(rng, n) for n in (20, 35, 49, 50, 51, 60, 90, 150)]
    rows = []
    for i in range(80):
        parts = [prose(rng, rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages).split()
            a = rng.randrange(0, 10)
            parts += [" ".join(p[a:]), prose(rng, rng.randrange(0, 30))]
        rows.append((i, "\n ".join(parts)))
    rows += [(100 + k, rows[k][1]) for k in range(20)]                      # exact copies
    near = rows[3][1].split()
    for k in range(12):                                                    # near copies
        w = list(near)
        w[rng.randrange(len(w))] = "changed"
        rows.append((150 + k, " ".join(w)))
    rows += [(200, "la " * 400), (201, "la " * 300), (202, "la " * 49), (203, None), (204, ""), (205, " \t"),
             (206, "é\x0b" * 120), (207, "é " * 130), (3, rows[60][1]), (60, rows[60][1]), (None, rows[4][1]), (None, "la " * 60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(random.Random(seed))
    got = remove_repeats(docs(spark, rows, clashes=True)).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got)
    want = brute(rows, 50)
    assert got == want
    assert sum(r[2] > 0 for r in want) > 30


def test_other_window(spark):
    rows = corpus(random.Random(5))
    got = remove_repeats(docs(spark, rows), window=12, period=7, cover=(1, 2, 4)).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows, 12)


def test_cover():
    check_cover(COVER, PERIOD)
    with pytest.raises(ValueError):
        check_cover((1, 2), 7)


def test_empty_table(spark):
    assert remove_repeats(docs(spark, [])).collect() == []


def test_a_third_of_the_rows_has_no_id_and_another_third_one_id(spark):
    rng = random.Random(11)
    passage = prose(rng, 70)
    rows = [(i, prose(rng, 40) + " " + passage) for i in range(40)]
    rows += [(None, prose(rng, 30) + " " + passage + " " + prose(rng, 20)) for _ in range(40)] + [(None, rows[0][1])] * 5
    rows += [(7, passage + " " + prose(rng, 60)) for _ in range(40)] + [(7, rows[5][1])] * 5
    got = remove_repeats(docs(spark, rows).repartition(5)).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got)
    assert got == brute(rows, 50)


@pytest.mark.parametrize("shift", [-50, (1 << 62), (1 << 43) - 120])
def test_any_ids(spark, shift):
    """Negative ids and ids that leave no room for the digest's bits."""
    rows = [(None if i is None else i + shift, t) for i, t in corpus(random.Random(6))[:60]]
    got = remove_repeats(docs(spark, rows)).collect()
    low = min(i for i, _ in rows if i is not None) - 1
    got = sorted((low if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got)
    big = [(None if i is None else i - shift, t) for i, t in rows]
    assert got == sorted((low if i == -1 else i + shift, *rest) for i, *rest in brute(big, 50))
