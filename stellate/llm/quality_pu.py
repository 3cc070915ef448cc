"""Quality classifier by positive-unlabelled learning.

Only trusted positives and unlabelled texts are learned from; no text is ever
taken as a negative.  With the class prior pi (the share of positives among
unlabelled texts) the risk of a scorer f under the logistic loss l is

    pi * E_P[l(f, +1)]  +  max(0, E_U[l(f, -1)] - pi * E_P[l(f, -1)])

whose second term estimates the loss on negatives and is never allowed below
zero: where a batch's estimate turns negative, the step goes back up on it.
The prior is estimated from the same samples: over the scores of a first
classifier of positives against unlabelled texts, on the halves that it didn't
see, the least ratio of the unlabelled to the positive share above a threshold.

Features are shares of neighbouring character classes and of repeated words
over the whole text, all computed on arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import NOT_SPACE, crc_mod, distinct, joined_texts, text_groups, words

SAMPLE = 6000        # positives, and unlabelled texts, that are learned from
THRESHOLD = 0.7
STEPS = 600

# fixed values: character classes, one per group of ASCII characters; 0 is everything else
GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".", ",", "!", "|",
          "#$%&*@^~+=<>", "'\"`", "()[]{}", "-_/\\", "?:;")
CLASS = np.zeros(256, np.int32)
for _n, _group in enumerate(GROUPS):
    CLASS[[ord(c) for c in _group]] = _n + 1
CLASS[0x80:] = len(GROUPS) + 1
N_CLASSES = len(GROUPS) + 2
N_FEATURES = N_CLASSES**2 + 4


def features(texts: pa.Array, first: int, last: int) -> np.ndarray:
    """One row of N_FEATURES numbers per text."""
    n = last - first
    data, docs = joined_texts(texts, b"", first, last)
    size = np.diff(docs)
    kind = CLASS[data]
    doc = np.repeat(np.arange(n, dtype=np.int32), size)
    pair = kind[:-1] * N_CLASSES + kind[1:] + doc[:-1] * N_CLASSES**2
    counts = np.bincount(pair[doc[:-1] == doc[1:]], minlength=n * N_CLASSES**2).reshape(n, -1)
    out = np.zeros((n, N_FEATURES), np.float32)
    out[:, :-4] = np.sqrt(counts / np.maximum(size - 1, 1)[:, None])
    # words: repeats of the word before, share of distinct words, length
    packed, starts, before = words(data, docs, NOT_SPACE)
    codes, values = distinct(packed, starts)
    n_words = np.diff(before)
    owner = np.repeat(np.arange(n), n_words)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    own_words = np.unique(owner * np.int64(max(1, len(values))) + codes)
    n_distinct = np.bincount(own_words // max(1, len(values)), minlength=n)
    some = np.maximum(n_words, 1)
    repeated = np.bincount(owner, again, n) / some
    out[:, -4] = np.sqrt(repeated)
    out[:, -3] = np.minimum(1, 10 * repeated)
    out[:, -2] = np.log1p(n_distinct) / np.log1p(some)
    out[:, -1] = np.log1p(n_words) / 10
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Linear:
    """A linear scorer on standardised features, fitted by Adam."""

    def __init__(self, x: np.ndarray):
        self.mean, self.std = x.mean(axis=0), x.std(axis=0) + 1e-3
        self.w = np.zeros(x.shape[1] + 1)

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -8, 8)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.inputs(x) @ self.w)

    def fit(self, gradient, steps: int, rate: float = 0.02, decay: float = 1e-3) -> "Linear":
        first, second = np.zeros_like(self.w), np.zeros_like(self.w)
        for i in range(1, steps + 1):
            g = gradient(self.w) + decay * np.append(self.w[:-1], 0)
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
            self.w = self.w - rate * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.999**i)) + 1e-8)
        return self


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS // 2) -> float:
    """The share of positives among the unlabelled, from features of both."""
    model = Linear(unlabelled)
    p, u = model.inputs(positive[::2]), model.inputs(unlabelled[::2])

    def gradient(w):
        return p.T @ (_sigmoid(p @ w) - 1) / len(p) + u.T @ _sigmoid(u @ w) / len(u)
    model.fit(gradient, steps)
    held_p, held_u = np.sort(model.score(positive[1::2])), np.sort(model.score(unlabelled[1::2]))
    if not len(held_p) or not len(held_u):
        return 0.5
    cuts = np.quantile(held_p, np.linspace(0, 0.9, 91))
    above_p = 1 - np.searchsorted(held_p, cuts) / len(held_p)
    above_u = 1 - np.searchsorted(held_u, cuts) / len(held_u)
    slack = np.sqrt(np.log(40) / 2)  # keeps small samples from a ratio that is low by chance
    ratio = (above_u + slack / np.sqrt(len(held_u))) / np.maximum(above_p - slack / np.sqrt(len(held_p)), 1e-9)
    best = np.argmin(np.where(above_p > 2 * slack / np.sqrt(len(held_p)), ratio, np.inf))
    return float(np.clip(above_u[best] / max(above_p[best], 1e-9), 0.02, 0.98))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> Linear:
    """Minimises the non-negative unbiased risk."""
    model = Linear(unlabelled)
    p, u = model.inputs(positive), model.inputs(unlabelled)

    def gradient(w):
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        # the loss on negatives, as unlabelled less positive
        risk = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        negative = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        if risk < 0:
            return -negative
        return prior * (p.T @ (sp - 1)) / len(p) + negative
    return model.fit(gradient, steps)


def _feature_rows(parts) -> Iterator[pa.RecordBatch]:
    for b in parts:
        texts = b.column("text")
        for first, last in text_groups(texts):
            x = features(texts, first, last)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(last - first + 1, dtype=np.int32) * N_FEATURES), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column(c).slice(first, last - first) for c in ("doc", "is_positive", "is_unlabelled")] + [flat],
                ["doc", "is_positive", "is_unlabelled", "x"])


def training_sample(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of at most ``sample`` trusted positives and as many unlabelled
    texts, both chosen by hash among the documents.  A document is an id and a
    text; its copies count once.  docs: ``doc_id, text``; labels: ``doc_id,
    quality``.  An id that any row labels 0 isn't trusted; labels of ids
    without a document take no place."""
    named = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("doc"))
    trusted = labels.groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")
    positive = _drawn(named.join(trusted, "doc_id", "left_semi"), 0, sample).withColumn("is_positive", F.lit(True))
    unlabelled = _drawn(named, 1, sample).withColumn("is_unlabelled", F.lit(True))
    chosen = positive.join(unlabelled, "doc", "full").select(
        "doc", F.coalesce("is_positive", F.lit(False)).alias("is_positive"),
        F.coalesce("is_unlabelled", F.lit(False)).alias("is_unlabelled"))
    rows = (docs.select(F.xxhash64("doc_id", "text").alias("doc"), "text")
            .join(F.broadcast(chosen), "doc")  # at most 2 * sample documents
            .groupBy("doc", "is_positive", "is_unlabelled").agg(F.first("text").alias("text"))
            .mapInArrow(_feature_rows, "doc bigint, is_positive boolean, is_unlabelled boolean, x array<float>")
            .orderBy("doc").toArrow())
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, N_FEATURES).astype(np.float64)
    return (x[rows.column("is_positive").to_numpy()], x[rows.column("is_unlabelled").to_numpy()])


def _drawn(rows: DataFrame, seed: int, sample: int) -> DataFrame:
    """``sample`` distinct values of ``doc`` by hash (all, if there are fewer)."""
    n = rows.agg(F.approx_count_distinct("doc")).first()[0]
    # about twice as many as are needed come to the ranking
    place = F.pmod(F.xxhash64("doc", F.lit(seed)), F.lit(1 << 40))
    near = rows.filter(place * F.lit(float(n)) < float((2 * sample + 100) * (1 << 40))).select("doc").distinct()
    return near.orderBy(place, "doc").limit(sample)


def _scored(parts, model: Linear | None) -> Iterator[pa.RecordBatch]:
    for b in parts:
        texts = b.column("text")
        for first, last in text_groups(texts):
            n = last - first
            score = model.score(features(texts, first, last)) if model else np.full(n, 0.5)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(first, n), pa.array(score, pa.float64())], ["doc_id", "score"])


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", folds: int = 4, held_out_fold: int = 2, sample: int = SAMPLE,
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Learns from rows whose crc32 of the id as text, modulo ``folds``, isn't
    ``held_out_fold``: at most ``sample`` trusted positives and ``sample``
    unlabelled texts.  The score reads the whole text alone; null and empty
    texts are scored like a text without characters.  Without a trusted
    positive every score is 0.5.  Null ids are never learned from and not
    held out; repeated rows stay; an empty table gives no rows; other columns
    are ignored.
    """
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marks = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("quality"))
    held = F.coalesce(crc_mod("doc_id", folds) == held_out_fold, F.lit(False))
    usable = F.col("doc_id").isNotNull() & ~held
    positive, unlabelled = training_sample(src.filter(usable), marks.filter(usable), sample)
    model = fit_nnpu(positive, unlabelled, estimate_prior(positive, unlabelled)) if len(positive) and len(unlabelled) else None
    shown = docs.sparkSession.sparkContext.broadcast(model)
    return (src.mapInArrow(lambda parts: _scored(parts, shown.value), "doc_id bigint, score double")
            .select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")))
