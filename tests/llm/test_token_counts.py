import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from cases import docs, prose

from stellate.llm.token_counts import PieceCounter, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]


def hard_texts():
    rng = random.Random(1)
    bits = ["a", "b", "ab", "the", " ", "  ", "\n", "\t", "é", "中", "文", "😀", "▁", "0", "123", "<s>", "</s>", "<0x0A>", "́",
            "ing", "tion", "aaaa", "    ", "\x00", "​", ". ", "!!"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(97, 123), rng.randrange(0x400, 0x450),
                                      rng.randrange(0x4E00, 0x5E00)])) for _ in range(rng.randrange(300))) for _ in range(800)]
    texts += [" " * n + w for n in range(1, 80) for w in ("", "a", "the", "\n", "中")]
    texts += ["a" * 100_001, "ab" * 50_000, "".join(rng.choice("abcdefghijklmnop") for _ in range(50_000)), " " * 100_000 + "the"]
    return texts


def test_counts_equal_the_library(library):
    texts = hard_texts()
    assert PieceCounter(MODEL).count_texts(pa.array(texts)).tolist() == library(texts)


def test_forgetting_changes_nothing(library, monkeypatch):
    counter = PieceCounter(MODEL)
    counter.memo.most = 10
    texts = hard_texts()[:500]
    assert counter.count_texts(pa.array(texts)).tolist() == library(texts)


def test_rows(spark, library):
    long = prose(random.Random(2), 30_000)
    rows = [(1, "Hello world"), (2, None), (3, ""), (4, long), (1, "Hello world"), (None, "é"), (5, " ")]
    got = token_counts(docs(spark, rows, clashes=True), MODEL).collect()
    want = [(i, len((t or "").encode()), n, n > 4096) for (i, t), n in zip(rows, library([t or "" for _, t in rows]))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts(docs(spark, []), MODEL).collect() == []
