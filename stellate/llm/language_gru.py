"""Language identification by a bidirectional gated recurrent network over bytes.

A text's words are runs of letter bytes (ASCII letters in lower case, and all
bytes of characters outside ASCII).  Two recurrent layers read each word's
bytes forwards and backwards from a word boundary, and a softmax over both
states labels every position with language probabilities.  A document's
probabilities are the mean over all positions of all its words.

Because the network starts anew at each word, a word's contribution depends
on the word alone: every distinct word runs through it once per worker.  The
network is trained here, in numpy, by backpropagation through time.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.common import Memo, crc_mod, distinct, joined_texts, stage, text_groups, words

UNKNOWN = "und"
HIDDEN = 16
LONGEST = 32             # characters that the network reads at once; longer words are read in pieces
SAMPLE_DOCS = 400        # training documents of each language
SAMPLE_WORDS = 60_000    # distinct pieces of words that are trained on, shared evenly by the languages
LEAST_WORDS = 500        # of each language, however many there are
BROADCAST_DOCS = 1 << 20 # training documents whose digests are broadcast; more are joined by an exchange
EPOCHS = 4
INFER = 1024            # words of one length that run side by side
MEMO_KEYS = 250_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[ord("a"):ord("z") + 1] = IN_WORD[0x80:] = True
#: a piece of a word in lower case, as the pattern of the training sample
WORD = f"[a-z\\u0080-\\x{{10FFFF}}]{{1,{LONGEST}}}"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class GRU:
    """One direction.  Gates in the order update, reset, candidate; inputs are one-hot bytes."""

    def __init__(self, hidden: int, rng: np.random.Generator | None):
        self.hidden = hidden
        if rng is not None:
            self.par = {"x": (rng.standard_normal((257, 3 * hidden)) * 0.3).astype(np.float32),
                        "h": (rng.standard_normal((hidden, 2 * hidden)) / np.sqrt(hidden)).astype(np.float32),
                        "c": (rng.standard_normal((hidden, hidden)) / np.sqrt(hidden)).astype(np.float32)}

    def forward(self, steps: np.ndarray, keep: bool = False):
        """steps: (time, batch) bytes.  States after every step; ``keep`` also returns what backward needs."""
        n, k = steps.shape[1], self.hidden
        state, out, saved = np.zeros((n, k), np.float32), np.empty((len(steps), n, k), np.float32), []
        for t, byte in enumerate(steps):
            x = self.par["x"][byte]
            gates = _sigmoid(x[:, :2 * k] + state @ self.par["h"])
            z, r = gates[:, :k], gates[:, k:]
            gated = r * state
            c = np.tanh(x[:, 2 * k:] + gated @ self.par["c"])
            if keep:
                saved.append((byte, state, z, r, gated, c))
            state = state + z * (c - state)
            out[t] = state
        return (out, saved) if keep else out

    def backward(self, saved: list, d_out: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients through time, given the loss's gradient by every state."""
        k = self.hidden
        grad = {name: np.zeros_like(p) for name, p in self.par.items()}
        d_state = np.zeros_like(d_out[0])
        for t in range(len(saved) - 1, -1, -1):
            byte, before, z, r, gated, c = saved[t]
            d_state = d_state + d_out[t]
            d_c = d_state * z * (1 - c * c)
            d_z = d_state * (c - before) * z * (1 - z)
            d_gated = d_c @ self.par["c"].T
            d_r = d_gated * before * r * (1 - r)
            d_zr = np.concatenate([d_z, d_r], axis=1)
            grad["c"] += gated.T @ d_c
            grad["h"] += before.T @ d_zr
            np.add.at(grad["x"], byte, np.concatenate([d_zr, d_c], axis=1))
            d_state = d_state * (1 - z) + d_gated * r + d_zr @ self.par["h"].T
        return grad


def word_pieces(word: bytes) -> list[bytes]:
    """A word cut every ``LONGEST`` characters."""
    if len(word) <= LONGEST:
        return [word]
    text = word.decode()
    return [text[a:a + LONGEST].encode() for a in range(0, len(text), LONGEST)]


class BiGRU:
    """Labels every byte of a word with class probabilities."""

    EDGE = 256  # stands before the first byte that a direction reads

    def __init__(self, classes: list[str], hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.ahead, self.back = GRU(hidden, rng), GRU(hidden, rng)
        self.out = {"w": (rng.standard_normal((2 * hidden, len(classes))) * 0.1).astype(np.float32),
                    "b": np.zeros(len(classes), np.float32)}

    def _steps(self, chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edge = np.full((1, len(chunk)), self.EDGE)
        return np.concatenate([edge, chunk.T]), np.concatenate([edge, chunk.T[::-1]])

    def _softmax(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both states of every position, and its probabilities."""
        both = np.concatenate([a[1:], b[1:][::-1]], axis=2)
        logit = both @ self.out["w"] + self.out["b"]
        e = np.exp(logit - logit.max(axis=2, keepdims=True))
        return both, e / e.sum(axis=2, keepdims=True)

    def probabilities(self, chunk: np.ndarray) -> np.ndarray:
        """chunk: (batch, length) bytes.  Probabilities: (length, batch, classes)."""
        a, b = self._steps(chunk)
        return self._softmax(self.ahead.forward(a), self.back.forward(b))[1]

    def gradients(self, chunk: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict:
        """Gradients of the weighted mean cross entropy over all positions."""
        a, b = self._steps(chunk)
        out_a, saved_a = self.ahead.forward(a, keep=True)
        out_b, saved_b = self.back.forward(b, keep=True)
        both, d = self._softmax(out_a, out_b)
        d[:, np.arange(len(label)), label] -= 1
        d *= (weight / weight.sum() / len(chunk.T))[None, :, None].astype(np.float32)
        d_both = d @ self.out["w"].T
        k = self.ahead.hidden
        zero = np.zeros((1, len(chunk), k), np.float32)
        d_a = np.concatenate([zero, d_both[:, :, :k]])
        d_b = np.concatenate([zero, d_both[::-1, :, k:]])
        return {"ahead": self.ahead.backward(saved_a, d_a), "back": self.back.backward(saved_b, d_b),
                "out": {"w": np.tensordot(both, d, axes=([0, 1], [0, 1])), "b": d.sum(axis=(0, 1))}}

    def parameters(self) -> dict[str, dict[str, np.ndarray]]:
        return {"ahead": self.ahead.par, "back": self.back.par, "out": self.out}

    # -------------------------------------------------------------- scoring

    def word_sums(self, values: list[bytes]) -> list[np.ndarray]:
        """For each word the sum of its positions' probabilities."""
        pieces, owner = [], []
        for i, v in enumerate(values):
            for piece in word_pieces(v):
                pieces.append(piece)
                owner.append(i)
        length, owner = np.array([len(p) for p in pieces]), np.array(owner)
        sums = np.zeros((len(values), len(self.classes)), np.float64)
        for n in np.unique(length):
            same = np.flatnonzero(length == n)
            for first in range(0, len(same), INFER):
                part = same[first:first + INFER]
                chunk = np.frombuffer(b"".join(pieces[i] for i in part), np.uint8).reshape(-1, n)
                np.add.at(sums, owner[part], self.probabilities(chunk).sum(axis=0))
        return list(sums)


def train(rows: list[tuple[str, str, int]], epochs: int = EPOCHS, seed: int = 0, hidden: int = HIDDEN) -> BiGRU:
    """rows: (language, piece of a word, times seen).  Adam on batches of words of one
    length; every language weighs the same."""
    rows = sorted(rows)
    classes = sorted({r[0] for r in rows})
    net, rng = BiGRU(classes, hidden, seed), np.random.default_rng(seed)
    label_of = {c: i for i, c in enumerate(classes)}
    byte = [w.encode() for _, w, _ in rows]
    label = np.array([label_of[c] for c, _, _ in rows])
    times = np.sqrt(np.array([n for _, _, n in rows], np.float64))
    weight = times / np.bincount(label, times)[label]
    length = np.array([len(b) for b in byte])
    first = {g: {k: np.zeros_like(v) for k, v in p.items()} for g, p in net.parameters().items()}
    second = {g: {k: np.zeros_like(v) for k, v in p.items()} for g, p in net.parameters().items()}
    step = 0
    for epoch in range(epochs):
        groups = []
        for n in np.unique(length):
            same = rng.permutation(np.flatnonzero(length == n))
            groups += [same[i:i + 256] for i in range(0, len(same), 256)]
        rate = 0.02 * 0.5 ** (4 * epoch / epochs)
        for i in rng.permutation(len(groups)):
            part = groups[i]
            chunk = np.frombuffer(b"".join(byte[j] for j in part), np.uint8).reshape(len(part), -1)
            grads, step = net.gradients(chunk, label[part], weight[part]), step + 1
            for g, params in net.parameters().items():
                for k, p in params.items():
                    d = np.clip(grads[g][k], -1, 1)
                    first[g][k] = 0.9 * first[g][k] + 0.1 * d
                    second[g][k] = 0.99 * second[g][k] + 0.01 * d * d
                    p -= (rate * (first[g][k] / (1 - 0.9**step)) / (np.sqrt(second[g][k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def training_words(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS) -> list[tuple]:
    """(language, piece of a word, times) from a bounded sample of labelled
    documents: ``sample_docs`` whole documents of every language, and of their
    distinct pieces an even share of ``sample_words`` for each language
    (``LEAST_WORDS`` at least), chosen by hash.  A document is an id (null too)
    and a text; its copies count once.  docs: ``doc_id, text, lang`` of the rows
    to learn from."""
    named = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("doc"))
    langs = stage(named.groupBy("lang").agg(F.approx_count_distinct("doc").alias("n_docs")), "languages")
    each = max(LEAST_WORDS, sample_words // max(1, langs.count()))
    # about twice as many as are needed, by hash, so that the ranking sees few rows however many tasks there are
    share = F.pmod("doc", F.lit(1 << 40)) / float(1 << 40)
    near = (named.select("doc", "lang").join(langs, "lang")
            .filter(share * F.col("n_docs") < 2 * sample_docs + 20).select("doc", "lang").distinct())
    order = Window.partitionBy("lang").orderBy(share, "doc")
    chosen = stage(near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= sample_docs)
                   .select("doc", "lang"), "language-sample")
    # counted: at most sample_docs for each language, however many languages there are
    few = chosen.count() <= BROADCAST_DOCS
    seen = (named.join(F.broadcast(chosen) if few else chosen, ["doc", "lang"])
            .groupBy("lang", "doc").agg(F.first("text").alias("text"))
            .select("lang", F.explode(F.regexp_extract_all(F.translate("text", ascii_uppercase, ascii_lowercase),
                                                           F.lit(WORD), F.lit(0))).alias("word"))
            .groupBy("lang", "word").count())
    drawn = Window.partitionBy("lang").orderBy(F.xxhash64("lang", "word"), "word")
    return [tuple(r) for r in seen.withColumn("nth", F.row_number().over(drawn)).filter(F.col("nth") <= each)
            .select("lang", "word", "count").collect()]


def _predicted(parts, net: BiGRU | None, keys: list[str]) -> Iterator[pa.RecordBatch]:
    classes = net.classes if net else []
    memo = Memo(net.word_sums, MEMO_KEYS) if net else None
    for b in parts:
        texts, lettered = b.column("text"), b.column("has_letter").to_numpy(zero_copy_only=False)
        for first, last in text_groups(texts):
            n = last - first
            lang, score = [UNKNOWN] * n, np.zeros(n)
            if classes:
                data, docs = joined_texts(texts, b"", first, last)
                packed, starts, before = words(LOWER[data], docs, IN_WORD)
                codes, values = distinct(packed, starts)
                sums = np.array(memo.values(values)).reshape(-1, len(classes))
                doc = np.repeat(np.arange(n), np.diff(before))
                pooled = np.stack([np.bincount(doc, sums[codes, c], n) for c in range(len(classes))], axis=1)
                size = np.bincount(doc, np.diff(starts), n)
                pooled /= np.maximum(size, 1)[:, None]
                best = pooled.argmax(axis=1)
                known = lettered[first:last].astype(bool) & (size > 0)
                lang = [classes[c] if k else UNKNOWN for c, k in zip(best, known)]
                score = np.where(known, np.clip(pooled[np.arange(n), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k).slice(first, n) for k in keys), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                [*keys, "lang_pred", "score"])


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5,
                  held_out_fold: int = 0, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS) -> BiGRU | None:
    """The network trained on rows whose crc32 of the id as text, modulo
    ``folds``, isn't ``held_out_fold`` (a null id is learned from), and whose
    text and language aren't null; None if no such row has a letter."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.col(lang_col).cast("string").alias("lang"))
    sample = training_words(src.filter(~_held_out("doc_id", folds, held_out_fold)), sample_docs, sample_words)
    return train(sample) if sample else None


def _held_out(id_col: str, folds: int, held_out_fold: int):
    return F.coalesce(crc_mod(id_col, folds) == held_out_fold, F.lit(False))


def label_languages(docs: DataFrame, net: BiGRU | None, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, and ``lang_pred`` and ``score`` (which
    must not be among them).  A row is labelled where it is read: nothing is
    exchanged."""
    shown = docs.sparkSession.sparkContext.broadcast(net)
    names, text = docs.columns, F.col(text_col).cast("string")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), text.alias("text"),
                         F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    kind = packed.schema["row"].dataType.simpleString()
    out = packed.mapInArrow(lambda parts: _predicted(parts, shown.value, ["row"]), f"row {kind}, lang_pred string, score double")
    return out.select("row.*", "lang_pred", "score")


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       folds: int = 5, held_out_fold: int = 0, sample_docs: int = SAMPLE_DOCS,
                       sample_words: int = SAMPLE_WORDS) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Learns as ``fit_languages`` does; the prediction reads the text alone.
    ``lang_pred`` is a learned language with ``score`` its pooled probability,
    or ``und`` with score 0 if the text is null or has no letter, or nothing
    could be learned.  Rows with a null id are not held out; repeated rows
    stay; an empty table gives no rows; other columns are ignored.
    """
    net = fit_languages(docs, id_col, text_col, lang_col, folds, held_out_fold, sample_docs, sample_words)
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shown = docs.sparkSession.sparkContext.broadcast(net)
    lettered = src.withColumn("has_letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    out = lettered.mapInArrow(lambda parts: _predicted(parts, shown.value, ["doc_id"]), "doc_id bigint, lang_pred string, score double")
    return out.select("doc_id", _held_out("doc_id", folds, held_out_fold).alias("held_out"), "lang_pred", "score")
