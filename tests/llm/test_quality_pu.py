import random
import zlib

import numpy as np
import pytest
from cases import docs, prose

from stellate.llm.quality_pu import estimate_prior, fit_nnpu, score_quality


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def corpus(n):
    rng = random.Random(2)
    rows, good = [], {}
    for i in range(n):
        good[i] = rng.random() < 0.75
        text = prose(rng, rng.randrange(20, 200), 4000) + "."
        if not good[i]:
            text = rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", " | "), (text.split()[0] + " ") * 80])
        rows.append((i, text))
    return rows, good


def test_held_out_accuracy_and_edge_cases(spark):
    rows, good = corpus(900)
    marks = [(i, int(good[i]), 0) for i in range(0, 900, 2)]
    marks += [(5000, 1, 0), (None, 1, 0), (1, None, 0), (2, int(good[2]), 0)]
    odd = [(2000, None), (2001, ""), (2002, " \n"), (2003, prose(random.Random(1), 60_000)), (3, rows[3][1]), (None, rows[5][1])]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    got = score_quality(docs(spark, rows + odd, clashes=True), labels, sample=600).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    by = {r.doc_id: r for r in got}
    test = [i for i in range(900) if held_out(i)]
    assert np.mean([by[i].predicted == int(good[i]) for i in test]) >= 0.97
    # labels of held-out rows aren't read
    flipped = spark.createDataFrame([(i, (1 - q if held_out(i) and q is not None else q), t) for i, q, t in marks], "doc_id bigint, quality int, toxic int")
    again = score_quality(docs(spark, rows), flipped, sample=600).collect()
    base = score_quality(docs(spark, rows), labels, sample=600).collect()
    assert sorted((r.doc_id, r.score) for r in again) == sorted((r.doc_id, r.score) for r in base)


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert score_quality(docs(spark, []), none).collect() == []
    r = score_quality(docs(spark, [(1, "a")]), none).first()
    assert (r.score, r.predicted) == (0.5, 0)


@pytest.mark.parametrize("share", [0.3, 0.6, 0.9])
def test_prior_and_risk(share):
    rng = np.random.default_rng(int(share * 10))
    positive = rng.normal(1.5, 1, (3000, 4))
    n = int(3000 * share)
    unlabelled = rng.permutation(np.concatenate([rng.normal(1.5, 1, (n, 4)), rng.normal(-1.5, 1, (3000 - n, 4))]))
    prior = estimate_prior(positive, unlabelled)
    assert abs(prior - share) < 0.06
    model = fit_nnpu(positive, unlabelled, prior)
    assert (model.score(rng.normal(1.5, 1, (500, 4))) > 0.5).mean() > 0.95
    assert (model.score(rng.normal(-1.5, 1, (500, 4))) < 0.5).mean() > 0.95


def test_labels_without_documents_and_ids_with_many_rows_take_no_place(spark):
    """Two hundred thousand positive labels of other ids, and one id with a thousand rows, change nothing that matters."""
    rows, good = corpus(400)
    marks = [(i, int(good[i])) for i in range(300)]
    foreign = spark.createDataFrame(marks, "doc_id bigint, quality int").unionByName(
        spark.range(10_000, 210_000).selectExpr("id as doc_id", "1 as quality"))
    got = {r.doc_id: r.score for r in score_quality(docs(spark, rows), foreign, sample=600).collect()}
    own = {r.doc_id: r.score for r in score_quality(docs(spark, rows), spark.createDataFrame(marks, "doc_id bigint, quality int"),
                                                    sample=600).collect()}
    assert got == own
    assert np.mean([got[i] for i in good if good[i]]) > 0.8 > 0.3 > np.mean([got[i] for i in good if not good[i]])
    copies = rows + [(1, rows[1][1])] * 1000
    again = {r.doc_id: r.score for r in score_quality(docs(spark, copies), foreign, sample=600).collect()}
    assert again == own
