import hashlib
import random

import corpus_pipeline as P
import public_tokenizers
import pytest
from cases import DOCS
from cases import docs as table
from test_decontaminate import brute as contaminated
from test_secret_ledger import brute as secret_spans
from test_simhash_dedup import components, fingerprint
from tokenizers import Tokenizer

from stellate.llm.language_gru import fit_languages, identify_languages, label_languages

WORDS = {"aa": "abcdefgh", "bb": "éèüßöñ", "cc": "stuvwxyz"}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(8)
    rows = [(i, text(rng, sorted(WORDS)[i % 3], rng.randrange(20, 90)), sorted(WORDS)[i % 3]) for i in range(160)]
    items = [(k, text(rng, "aa", 25)) for k in range(6)]
    rows += [(200 + k, rows[k][1], rows[k][2]) for k in range(25)]                        # copies
    rows += [(230 + k, rows[k][1] + " " + items[k % 6][1], "aa") for k in range(30, 40)]     # passages
    rows += [(280 + k, rows[k][1] + " token = abcdef0123", "bb") for k in range(40, 50)]   # secrets
    rows += [(400, None, None), (401, "", "aa"), (402, "123 456", "aa"), (403, text(rng, "cc", 9000), "cc"),
             (5, rows[5][1], "aa"), (None, text(rng, "aa", 30), None)]
    d = tmp_path_factory.mktemp("sf")
    full = [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows]
    spark.createDataFrame(full, DOCS).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), full, items


def order(r):
    """Null ids last, then by the whole row."""
    return (r[0] is None, r[0] or 0, repr(r[1:]))


def test_run_matches_brute_force(spark, tables):
    """Each stage as its docstring says, in plain Python; the stages share no code with it but the language network."""
    d, rows, items = tables
    pred = {(r.doc_id, r.text): r.lang_pred for r in label_languages(
        spark.read.parquet(f"{d}/documents.parquet"), fit_languages(spark.read.parquet(f"{d}/documents.parquet"))).collect()}
    kept = [r for r in rows if pred[r[0], r[1]] != "und"]
    assert {400, 401, 402} & {r[0] for r in kept} == set()
    fps = {r[:2]: fingerprint(r[1]) for r in kept}
    comp = components({f: f for f in fps.values()}, 2)
    groups = {}
    for r in kept:
        groups.setdefault(comp[fps[r[:2]]], []).append(r)

    def first(r):
        key = hashlib.sha256(f"{'null' if r[0] is None else r[0]} {r[1] or ''}".encode()).digest()
        return (r[0] is None, r[0] or 0, key, [(x is not None, x) for x in r])
    kept = [min(g, key=first) for g in groups.values()]
    assert sum(r[0] is None for r in kept) == 1 and len(kept) < len(rows) - 20
    hit = {i for i, *_, bad in contaminated([r[:2] for r in kept], items) if bad}
    assert hit and None not in hit
    kept = [r for r in kept if r[0] not in hit]
    clean = [r for r in kept if not secret_spans(r[1])]
    assert len(clean) < len(kept)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = [(r[0], p, min(4096, n - p * 4096)) for r in clean
            for n in [len(tokenizer.encode(r[1], add_special_tokens=False).ids) + 1] for p in range(-(-n // 4096))]
    got = [(r.doc_id, r.piece, r.length) for r in P.run(spark, d).collect()]
    assert sorted(got, key=order) == sorted(want, key=order)
    assert len(want) > 100


def test_language_fills_what_is_missing_and_keeps_an_unlabelled_corpus(spark, tables):
    _, rows, _ = tables
    missing = [(i, t, None if i is not None and i % 4 == 1 else lang) for i, t, lang, *_ in rows[:160]]
    got = {r.doc_id: r.lang for r in P.language(spark, table(spark, missing), "").collect()}
    assert got == {i: lang for i, _, lang, *_ in rows[:160]}
    none = [(i, t, None) for i, t, *_ in rows]
    assert rows_of(P.language(spark, table(spark, none), "")) == rows_of(table(spark, none))


@pytest.mark.parametrize("name", ["language", "decontamination"])
def test_row_local_stages_exchange_no_text(spark, tables, name):
    d, _, _ = tables
    plan = dict(P.STAGES)[name](spark, spark.read.parquet(f"{d}/documents.parquet"), d)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("bound", [0, 1 << 20])
def test_verdicts_by_broadcast_and_by_exchange(spark, tables, monkeypatch, bound):
    d, rows, _ = tables
    monkeypatch.setattr(P, "BROADCAST_KEYS", bound)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got = rows_of(P.secrets(spark, docs, d))
    assert got == sorted([(r[0], r[1], r[3]) for r in rows if not secret_spans(r[1])], key=repr)


def test_stages_return_documents(spark, tables):
    d, _, _ = tables
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, step in P.STAGES[:-1]:
        assert step(spark, docs, d).schema.names == docs.schema.names, name


def test_stages_take_an_empty_table(spark, tables):
    d, _, _ = tables
    none = spark.createDataFrame([], DOCS)
    for name, step in P.STAGES:
        assert step(spark, none, d).count() == 0, name


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=repr)


def test_near_duplicates_keep_one_row_of_each_group(spark, tables):
    """Groups of null ids alone, and groups whose least ids are the same, lose nothing."""
    rng = random.Random(3)
    a, b, c, d, e = (text(rng, "aa", 60) for _ in range(5))
    rows = [(None, a), (None, a), (None, b), (5, c), (7, c), (5, d), (9, d), (5, d), (None, e), (3, e)]
    full = [(i, t, None, f"s{n}", len(t)) for n, (i, t) in enumerate(rows)]
    want = sorted([(None, a, "s0"), (None, b, "s2"), (5, c, "s3"), (5, d, "s5"), (3, e, "s9")], key=repr)
    for _ in range(2):
        rng.shuffle(full)
        assert rows_of(P.near_duplicates(spark, spark.createDataFrame(full, DOCS).repartition(4), "")) == want


@pytest.mark.parametrize("name", ["language", "decontamination", "secrets"])
def test_rows_of_one_id_have_verdicts_of_their_own(spark, tables, name):
    d, rows, items = tables
    rng = random.Random(6)
    good, other = text(rng, "aa", 40), text(rng, "aa", 40)
    bad = {"language": "123 456", "decontamination": good + " " + items[0][1], "secrets": good + " token = abcdef0123"}[name]
    mixed = [(i, t, "aa") for i in (5, None) for t in (good, bad, other, bad, good)]
    got = dict(P.STAGES)[name](spark, table(spark, mixed), d)
    assert rows_of(got) == sorted([(i, t, "src") for i in (5, None) for t in (good, other, good)], key=repr)


def test_run_keeps_null_ids(spark, tables):
    d, _, _ = tables
    assert [r.piece for r in P.run(spark, d).collect() if r.doc_id is None] == [0]


def test_language_keeps_documents_with_a_low_score(spark):
    """Words that many languages share pool to a low probability in each of them."""
    rng = random.Random(2)
    langs = [f"l{n}" for n in range(8)]
    rows = [(i, text(rng, "aa", 30), langs[i % 8]) for i in range(160)]
    scores = [r.score for r in identify_languages(table(spark, rows)).collect()]
    assert min(scores) < 0.4
    assert rows_of(P.language(spark, table(spark, rows), "")) == sorted([(i, t, "src") for i, t, _ in rows], key=repr)
