import random
import zlib

import numpy as np
from cases import docs

from stellate.llm.language_gru import BiGRU, identify_languages, train, training_words, word_pieces


def held_out(i, n=5, fold=0):
    return i is not None and zlib.crc32(str(i).encode()) % n == fold


def test_gradients_are_those_of_the_loss():
    net = BiGRU(["a", "b", "c"], hidden=4, seed=1)
    for p in net.parameters().values():
        for k in p:
            p[k] = p[k].astype(np.float64)
    rng = np.random.default_rng(0)
    chunk, label, weight = rng.integers(97, 103, (5, 4)).astype(np.uint8), rng.integers(0, 3, 5), rng.random(5) + 0.1

    def loss():
        p = net.probabilities(chunk).astype(np.float64)
        return -(np.log(p[:, np.arange(5), label]) * weight / weight.sum()).sum() / 4
    grads = net.gradients(chunk, label, weight)
    for g, params in net.parameters().items():
        for k, p in params.items():
            flat, d = p.reshape(-1), grads[g][k].reshape(-1)
            for i in np.argsort(-np.abs(d))[:4]:
                old, step = flat[i], 1e-2
                flat[i] = old + step
                up = loss()
                flat[i] = old - step
                down = loss()
                flat[i] = old
                assert abs((up - down) / (2 * step) - d[i]) < 2e-3 * max(1, abs(d[i]) * 20)


ALPHABETS = {"aa": "abcdefgh", "bb": "éèüßöñ", "cc": "stuvwxyz"}


def corpus(n):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        lang = sorted(ALPHABETS)[i % 3]
        words = ["".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(3, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_held_out_accuracy_and_edge_cases(spark):
    rows = corpus(300)
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !!", "bb"), (1003, "abc " * 30_000, None), (1004, "x" * 50_000, "cc"),
           (1005, "中文", None), (1006, "—", None), (7, rows[7][1], "aa"), (None, rows[8][1], "cc")]
    got = identify_languages(docs(spark, rows + odd, clashes=True)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == held_out(r.doc_id) for r in got) and all(0 <= r.score <= 1 for r in got)
    test = [(i, lang) for i, _, lang in rows if held_out(i)]
    assert len(test) > 40 and np.mean([by[i].lang_pred == lang for i, lang in test]) >= 0.98
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1000, 1001, 1002, 1006))
    assert by[1003].lang_pred == "aa" and by[1004].lang_pred == "cc" and by[1005].lang_pred in ALPHABETS


def test_reads_only_the_text(spark):
    """Shuffling lang of the held-out rows, ids' sources and lengths changes nothing."""
    rows = corpus(90)
    changed = [(i, t, "zz" if held_out(i) else lang) for i, t, lang in rows]
    a = {r.doc_id: (r.lang_pred, r.score) for r in identify_languages(docs(spark, rows)).collect()}
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in identify_languages(docs(spark, changed)).collect()}


def test_nothing_to_learn(spark):
    assert identify_languages(docs(spark, [])).collect() == []
    r = identify_languages(docs(spark, [(1, "text", None)])).first()
    assert (r.lang_pred, r.score) == ("und", 0.0)


def test_a_word_counts_by_its_positions():
    net = train([("a", "abc", 3), ("b", "xyz", 2)], epochs=1)
    long = bytes(range(97, 120)) * 4
    total = net.word_sums([long, b"abc"])
    assert abs(total[0].sum() - len(long)) < 1e-3 and abs(total[1].sum() - 3) < 1e-3


def test_null_ids_are_learned_from(spark):
    """More rows with a null id than the sample holds, all texts their own; copies take one place."""
    rows = [(None if lang == "aa" else i, t, lang) for i, t, lang in corpus(300)]
    rows += [(None, rows[0][1], "aa")] * 100
    got = identify_languages(docs(spark, rows), sample_docs=40).collect()
    assert len(got) == 400
    assert np.mean([r.lang_pred == "aa" for r in got if r.doc_id is None]) >= 0.98
    assert np.mean([r.lang_pred != "aa" for r in got if r.doc_id is not None]) >= 0.98


def test_one_id_with_many_texts_is_one_document_each(spark):
    rows = [(7, t, lang) for _, t, lang in corpus(300) if lang == "aa"]
    sample = training_words(docs(spark, rows).select("doc_id", "text", "lang"), sample_docs=5)
    assert {w for _, w, _ in sample} < {w for _, t, _ in rows for w in t.split()}
    assert sum(n for _, _, n in sample) <= 5 * 60


def held_out_accuracy(spark, rows):
    got = {r.doc_id: r.lang_pred for r in identify_languages(docs(spark, rows)).collect()}
    test = [(i, lang) for i, _, lang in rows if held_out(i)]
    return np.mean([got[i] == lang for i, lang in test])


def test_scripts_without_spaces(spark):
    """Whole texts without a space that begin alike and differ after that."""
    rng = random.Random(4)
    signs = {"ja": "のはをにがでとしてれさあい", "zh": "的是不了在有我他这中大来上"}
    shared = "".join(chr(0x4E00 + 7 * i) for i in range(12))
    rows = [(i, shared + "".join(rng.choice(signs[lang]) for _ in range(200)), lang) for i, lang in
            ((i, ("ja", "zh")[i % 2]) for i in range(160))]
    assert held_out_accuracy(spark, rows) >= 0.95


def test_pieces_lose_nothing_and_cut_between_characters():
    for word in (b"a", b"x" * 32, b"x" * 33, ("é" * 40).encode(), ("中文字" * 30 + "a").encode(), ("😀" * 9).encode()):
        pieces = word_pieces(word)
        assert b"".join(pieces) == word and all(0 < len(p.decode()) <= 32 for p in pieces)


def test_every_language_is_learned_whatever_the_others_hold(spark):
    """One language with a hundred times the words of the others takes no place of theirs, and none is left out."""
    rng = random.Random(9)
    letters = [chr(0x400 + 8 * n + k) for n in range(60) for k in range(4)]
    rows = []
    for n in range(60):
        own = letters[4 * n:4 * n + 4]
        rows += [(len(rows) + k, " ".join("".join(rng.choice(own) for _ in range(6)) for _ in range(8)), f"l{n:02}") for k in range(6)]
    big = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    rows += [(len(rows) + k, big[k * 30:] + big[:k * 30], "zz") for k in range(10)]
    sample = training_words(docs(spark, rows).select("doc_id", "text", "lang"), sample_words=1000)
    assert len({lang for lang, *_ in sample}) == 61
    assert max(sum(1 for s in sample if s[0] == lang) for lang in {s[0] for s in sample}) <= 500
