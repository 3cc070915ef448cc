import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from cases import DOCS, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stellate.llm import mixture_packing
from stellate.llm.byte_bpe import ByteEncoder
from stellate.llm.mixture_packing import RoundRobin, mix_documents
from stellate.llm.queries import op13_mixture_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "the", "The", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", "　", "é", "É", "́", "中文", "×", "😀",
        "<|endoftext|>", "<|endoftext", "|>", "|", "<", "'s", "'ll", "'S", "123", "!!", "İ", "ﬁ", "\x00", "​", "don't", "'", "²", "('", "\n\n"]


def hard_texts(n):
    rng = random.Random(4)
    return ["".join(rng.choice(BITS) for _ in range(rng.randrange(40))) for _ in range(n)] + ["x" * 30_000, " " * 3000 + "a", ""]


@pytest.mark.parametrize("panics", [False, True])
def test_ids_equal_the_library(panics):
    encoder, library = ByteEncoder(PATH), Tokenizer.from_file(PATH)
    if panics:
        class PanicException(BaseException):
            pass

        class Broken:
            def encode_to_numpy(self, text, allowed_special):
                raise PanicException
        encoder.encoding = Broken()
    texts = [*hard_texts(300 if panics else 4000), None]
    ids, offsets = encoder.encode(pa.array(texts), 0, len(texts), 0)
    for t, a, b in zip(texts, offsets, offsets[1:]):
        assert ids[a:b].tolist() == library.encode(t or "", add_special_tokens=False).ids + [0]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        ByteEncoder(public_tokenizers.path("word_bpe_49k.json"))


def rounds(robin, totals, slot):
    """Deficit round-robin, one credit at a time: (queue, place in it) of every token."""
    left, credit, taken, out = list(totals), [0] * len(totals), [0] * len(totals), []
    while any(left):
        for q in range(len(totals)):
            credit[q] += int(robin.credit[q])
            slots, credit[q] = credit[q] >> 20, credit[q] & (1 << 20) - 1   # the rest is carried
            n = min(left[q], slots * slot)
            out += [(q, taken[q] + i) for i in range(n)]
            taken[q], left[q] = taken[q] + n, left[q] - n
    return out


def test_places_equal_the_rounds():
    rng = random.Random(2)
    for _ in range(120):
        totals = [rng.choice([0, rng.randrange(1, 3000)]) for _ in range(rng.randrange(1, 6))]
        if not sum(totals):
            continue
        weights = [float(max(1, t)) for t in totals] if rng.random() < 0.5 else [rng.random() + 0.01 for _ in totals]
        slot = rng.choice([1, 8, 32, 64])
        robin = RoundRobin(totals, weights, 256, slot)
        place, queue, n = [], [], []
        for q, t in enumerate(totals):
            at = 0
            while at < t:
                k = min(t - at, rng.randrange(1, 700))
                place, queue, n, at = [*place, at], [*queue, q], [*n, k], at + k
        pieces = list(zip(*(x.tolist() for x in robin.pieces(np.array(place), np.array(queue), np.array(n)))))
        flat = [(queue[d], place[d] + start + i) for d, start, length, _, _ in sorted(pieces, key=lambda p: p[3:]) for i in range(length)]
        assert flat == rounds(robin, totals, slot)


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, s, 0) for i, t, s in rows], DOCS)


def check_pieces(got, rows, capacity=1024):
    library = Tokenizer.from_file(PATH)
    of, docs = {}, {}
    for r in got:
        of.setdefault(r.sequence_id, []).append((r.offset, r.length, r.source))
        docs.setdefault((str(r.doc_id), str(r.source)), []).append((r.start, bytes(r.ids), r.doc_tokens))
    for parts in of.values():
        at = 0
        for offset, length, _ in sorted(parts, key=lambda p: p[0]):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at < capacity and at & (at - 1) == 0
    want = {}
    for i, t, s in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want.setdefault((str(i), str(s)), []).append(np.array(ids, "<u4").tobytes())
    assert set(want) == set(docs)
    for key, texts in want.items():
        if len(texts) == 1:
            at, whole = 0, b""
            for start, ids, n in sorted(docs[key]):
                assert start == at and len(ids) % 4 == 0 and n == len(texts[0]) // 4
                at, whole = at + len(ids) // 4, whole + ids
            assert whole == texts[0]
        else:
            assert sum(len(x[1]) for x in docs[key]) == sum(map(len, texts))
    return of


def rows_of(seed=6, n=200):
    rng = random.Random(seed)
    rows = [(i, t, f"s{i % 4}") for i, t in enumerate(hard_texts(n))]
    rows += [(1000 + i, prose(rng, rng.randrange(1, 900)), rng.choice(["s0", "s0", "s1", "big", "big", "big"])) for i in range(150)]
    return rows + [(2000, None, "s1"), (2001, "no source", None), (2002, "", ""), (None, "null id", "s2"), (7, rows[7][1], rows[7][2])]


@pytest.mark.parametrize("case", ["broadcast", "exchange", "few queues"])
def test_round_trip(spark, monkeypatch, case):
    if case == "exchange":
        monkeypatch.setattr(mixture_packing, "BROADCAST_ROWS", 0)
    rows = rows_of()
    df = table(spark, rows).repartition(7).withColumns({c: F.lit("x") for c in ("task", "before", "n", "ids", "queue", "place", "name")})
    check_pieces(mix_documents(df, PATH, most_queues=2 if case == "few queues" else 256).collect(), rows)


def test_windows_hold_the_proportions(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randrange(50, 400)), rng.choice(["a", "b", "b", "c", "c", "c", "c"])) for i in range(500)]
    for targets in (None, {"a": 1, "b": 1, "c": 2}):
        got = mix_documents(table(spark, rows).repartition(6), PATH, targets=targets, slot=32).collect()
        of = check_pieces(got, rows)
        totals = {s: sum(r.length for r in got if r.source == s) for s in "abc"}
        weights = totals if targets is None else targets
        share = {s: weights[s] / sum(weights.values()) for s in "abc"}
        # up to where the first queue runs out
        full = int(min(totals[s] / share[s] for s in "abc") // 1024) - 1
        assert full > 20
        upto = dict.fromkeys("abc", 0)
        for k in range(full):
            held = {s: sum(n for _, n, x in of[k] if x == s) for s in "abc"}
            for s in "abc":
                assert abs(held[s] - share[s] * 1024) <= 2 * 32 * 2
                upto[s] += held[s]
                assert abs(upto[s] - share[s] * 1024 * (k + 1)) <= 32 * 3   # deficits are carried, not lost


def test_edges(spark):
    assert mix_documents(table(spark, []), PATH).collect() == []
    one = mix_documents(table(spark, [(1, None, None)]), PATH).collect()
    assert [(r.doc_id, r.start, r.length, bytes(r.ids), r.sequence_id, r.offset) for r in one] == [(1, 0, 1, b"\0\0\0\0", 0, 0)]
    rows = [(i, "same words", "s") for i in range(3000)]
    check_pieces(mix_documents(table(spark, rows).repartition(3), PATH, targets={"elsewhere": 1, "s": 1}).collect(), rows)
    for bad in ({"slot": 100}, {"targets": {"s": -1}}, {"targets": {"t": 1}}, {"end_id": 60_000}):
        with pytest.raises(ValueError):
            mix_documents(table(spark, rows[:3]), PATH, **bad)


def test_query(spark, tmp_path):
    rows = rows_of(9, 20)
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_mixture_packing(spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(PATH)
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t, _ in rows if i not in (7, None)}
    for r in got:
        if r.doc_id in ids:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes())
            assert r.doc_tokens == len(ids[r.doc_id])
