import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import docs, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stellate.llm import bestfit_packing
from stellate.llm.bestfit_packing import PIECES, BestFit, pack_documents, pack_pieces

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ids_of():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def hard_rows():
    rng = random.Random(4)
    bits = ["a", "the", "The", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x85", " ", "　", "é", "É", "́", "Σ", "中文",
            "😀", "<|endoftext|>", "<|startoftext|>", "'s", "'ll", "123", "!!", "İ", "ﬁ", "\x00", "​", "don't", "e"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(40)))) for i in range(400)]
    rows += [(500 + i, prose(rng, rng.randrange(1, 3000))) for i in range(40)]
    rows += [(600, None), (601, ""), (602, " \n"), (603, prose(rng, 20_000)), (604, "x" * 30_000), (3, rows[3][1]), (None, "null id")]
    return rows


@pytest.mark.parametrize("shard_tokens", [1 << 20, 6000])
def test_pieces_round_trip(spark, ids_of, shard_tokens):
    rows = hard_rows()
    got = pack_documents(docs(spark, rows, clashes=True), PATH, shard_tokens=shard_tokens, most_open=16).collect()
    want = []
    for i, t in rows:
        ids = ids_of(t)
        for p in range(0, len(ids), 4096):
            part = np.array(ids[p:p + 4096], "<u4")
            want.append((-1 if i is None else i, p // 4096, p, len(part), zlib.crc32(part.tobytes())))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    of = {}
    for r in got:
        of.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in of.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(w[3] for w in want)
    assert len(of) <= -(-total // 4096) * 1.04 + 1
    assert pack_documents(docs(spark, []), PATH).collect() == []


def test_best_fit_keeps_the_bound():
    rng = random.Random(1)
    bins, used = BestFit(100, 5), {}
    for _ in range(4000):
        n = rng.randrange(1, 101)
        open_before = {b: 100 - f for f in range(101) for b in bins.by_free[f]}
        fits = [f for f in range(n, 101) if bins.by_free[f]]
        chosen, offset = bins.place(n)
        if fits:
            assert offset == 100 - min(fits)          # the fullest that it fits
        else:
            assert offset == 0 and chosen not in used
            if len(open_before) == 5:                 # the fullest closed
                closed = set(open_before) - {b for f in range(101) for b in bins.by_free[f]}
                assert max(open_before.values()) in {open_before[b] for b in closed}
        assert used.get(chosen, 0) == offset
        used[chosen] = offset + n
        assert used[chosen] <= 100
        assert sum(map(len, bins.by_free)) == bins.n_open <= 5
        assert bins.bits == sum(1 << f for f in range(101) if bins.by_free[f])


@pytest.mark.parametrize("small", [0, 300])
def test_rounds_end_when_no_two_pieces_fit(spark, monkeypatch, small):
    """500 pieces of which no two share a sequence: no round can close one."""
    rounds, stage = [], bestfit_packing.stage

    def counted(df, name):
        rounds.append(name)
        assert len(rounds) <= 20, "the rounds don't end"
        return stage(df, name)
    monkeypatch.setattr(bestfit_packing, "stage", counted)
    rows = [(i, 0, 0, 3000, i) for i in range(500)] + [(1000 + i, 0, 0, 400, i) for i in range(small)]
    got = pack_pieces(spark.createDataFrame(rows, PIECES), shard_tokens=30_000).collect()
    assert sorted((r.doc_id, r.length) for r in got) == sorted((r[0], r[3]) for r in rows)
    of = {}
    for r in got:
        of.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in of.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(of) == 500


def test_equal_rows_are_spread_over_all_shards(spark):
    rows = [(None, "one text that all rows share")] * 6000
    n_ids = len(Tokenizer.from_file(PATH).encode(rows[0][1], add_special_tokens=False).ids) + 1
    shards = []

    def staged(df, name, stage=bestfit_packing.stage):
        out = stage(df, name)
        if name == "packed":
            shards.append({r["shard"]: r["n"] for r in out.groupBy("shard").agg(F.sum("length").alias("n")).collect()})
        return out
    bestfit_packing.stage, kept = staged, bestfit_packing.stage
    try:
        got = pack_documents(docs(spark, rows).repartition(5), PATH, shard_tokens=5000).collect()
    finally:
        bestfit_packing.stage = kept
    assert len(got) == 6000
    planned = -(-6000 * n_ids // 5000)
    assert len(shards[0]) == planned and max(shards[0].values()) < 2 * 5000


def test_files_with_other_cut_places_are_refused():
    with pytest.raises(ValueError):
        bestfit_packing.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
