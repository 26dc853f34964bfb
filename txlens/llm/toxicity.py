"""Toxicity by a linear-chain conditional random field over the words of a text.

1. Word statistics over every labelled row: how often words and their prefixes
   occur in toxic and in clean documents. Words of toxic documents that have a
   strongly toxic word or prefix are the tokens labelled toxic; all words of
   clean documents are labelled clean.
2. The field (two labels; hashed word, prefix and suffix features; transitions)
   is fitted by gradient ascent on a bounded sample of labelled documents.
3. Forward-backward marginals of every word give the offending offsets and, by a
   logistic function of their largest value, sum and share, the document score.

Scores depend on the text alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import fits_broadcast, stage

SAMPLE_DOCS = 1500      # labelled documents of each class that the fit may gather
SAMPLE_CHARS = 20_000   # longest document (whole) that the sample takes
MIN_SUPPORT = 4         # occurrences in toxic documents, at least, and
MIN_SHARE = 0.002       # per toxic document, so that at most a bounded number of words qualifies
MIN_LIFT = 12.0         # toxic over clean frequency
PREFIXES = (3, 4, 5, 6)
BUCKETS = 1 << 16
MEMORY = 400_000        # words whose score a worker remembers
CHUNK = 400_000         # words scored at once
LABEL_BYTES = 32 << 20  # labels are broadcast up to this measured size
RESULT = "struct<score:double,spans:array<struct<start:long,end:long>>>"
_WORD = re.compile(r"\S+")
_EDGE = " \t.,;:!?\"'()[]{}<>*#$%&+=~|/\\_-`^@"


def normal(word: str) -> str:
    """Lower case, without punctuation at the edges (the word itself where nothing else is left)."""
    return word.lower().strip(_EDGE) or word


def features(word: str) -> list[int]:
    """Hashed features of a word: itself, its prefixes and its suffix; padded to a fixed number."""
    w = normal(word)
    names = [f"w={w}", *[f"p{k}={w[:k]}" if len(w) >= k else f"p{k}" for k in PREFIXES], f"s3={w[-3:]}"]
    return [zlib.crc32(n.encode()) % BUCKETS for n in names]


def marginals(emit: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray, pairs: bool = False):
    """P(label 1) of every word of chains laid end to end; with ``pairs`` also the summed P(label, next label).

    ``emit``: log-odds of label 1; ``first``: where a chain begins. Exact
    forward-backward: products of 2x2 transition matrices inside blocks (all
    blocks at once), carried from block to block. A chain's first matrix forgets what
    came before, so chains need no separate treatment.
    """
    n = len(emit)
    if n == 0:
        return (np.zeros(0), np.zeros((2, 2))) if pairs else np.zeros(0)
    width = max(1, min(256, int(np.sqrt(n))))
    blocks = -(-n // width)
    on = 1 / (1 + np.exp(-np.clip(emit, -30, 30)))
    psi = np.stack([1 - on, on], -1)
    mats = np.broadcast_to(np.exp(trans), (n, 2, 2)) * psi[:, None, :]
    mats[first] = (np.exp(start) * psi[first])[:, None, :]
    pad = np.broadcast_to(np.eye(2), (blocks * width - n, 2, 2))
    mats = np.concatenate([mats, pad]).reshape(blocks, width, 2, 2)

    def norm(x):
        return x / x.reshape(len(x), -1).sum(1).reshape(-1, *[1] * (x.ndim - 1))

    before = np.empty_like(mats)
    run = np.broadcast_to(np.eye(2), (blocks, 2, 2))
    for j in range(width):
        run = norm(run @ mats[:, j])
        before[:, j] = run
    alpha0, a = np.empty((blocks, 2)), np.array([0.5, 0.5])
    for b in range(blocks):
        alpha0[b] = a
        a = a @ before[b, -1]
        a = a / a.sum()
    alpha = np.einsum("bi,bjik->bjk", alpha0, before)
    after = np.empty((blocks, width, 2))
    beta0, last = np.empty((blocks, 2)), np.ones(2)
    for b in range(blocks - 1, -1, -1):
        beta0[b] = last
        last = before[b, -1] @ last
        last = last / last.sum()
    run = beta0
    for j in range(width - 1, -1, -1):
        after[:, j] = run
        run = np.einsum("bik,bk->bi", mats[:, j], run)
        run = run / run.sum(1, keepdims=True)
    both = (alpha * after).reshape(-1, 2)[:n]
    p = both[:, 1] / both.sum(1)
    if not pairs:
        return p
    prev = alpha.reshape(-1, 2)[:n - 1]
    xi = prev[:, :, None] * mats.reshape(-1, 2, 2)[1:n] * after.reshape(-1, 2)[1:n, None, :]
    xi = (xi / xi.sum((1, 2), keepdims=True))[~first[1:]].sum(0)
    return p, xi


def _layout(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words of all texts, where each text's chain begins, and the words per text."""
    split = [t.split() if t else [] for t in texts]
    count = np.array([len(s) for s in split], int)
    first = np.zeros(int(count.sum()), bool)
    first[(np.cumsum(count) - count)[count > 0]] = True
    return [w for s in split for w in s], first, count


def summary(p: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Per text: log-odds of the largest marginal, log of the expected toxic words, log of their share, 1."""
    top, total = np.zeros(len(count)), np.zeros(len(count))
    has = count > 0
    if has.any():
        at = (np.cumsum(count) - count)[has]
        top[has], total[has] = np.maximum.reduceat(p, at), np.add.reduceat(p, at)
    top = np.clip(top, 1e-6, 1 - 1e-6)
    return np.column_stack([np.log(top / (1 - top)), np.log(total + 1e-4), np.log((total + 1e-4) / (count + 1)), np.ones(len(count))])


@dataclass
class ToxicityModel:
    """Weights of the field, and of the logistic function on ``summary``."""

    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray
    head: np.ndarray

    def result(self, text: Column) -> Column:
        """``struct<score, spans>`` of a text column; spans of offending words in code points, neighbours merged.

        Null and empty texts are scored like any other (no words) and have no spans.
        """
        model = self

        @F.pandas_udf(RESULT)
        def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            memory = _Emissions(model.weights)
            for texts in batches:
                yield model.score(texts.tolist(), memory)

        return tag(text)

    def score(self, texts: list, memory: _Emissions | None = None) -> pd.DataFrame:
        memory = memory if memory is not None else _Emissions(self.weights)
        scores, spans, chunk, size = [], [], [], 0
        for text in [*texts, None]:
            chunk.append(text)
            size += len(text) if text else 0
            if size > 6 * CHUNK or len(chunk) + len(scores) > len(texts):
                if len(chunk) + len(scores) > len(texts):
                    chunk = chunk[:len(texts) - len(scores)]
                words, first, count = _layout(chunk)
                emit = np.fromiter(map(memory.__getitem__, words), float, len(words))
                p = marginals(emit, first, self.trans, self.start)
                scores += list(1 / (1 + np.exp(-np.clip(summary(p, count) @ self.head, -30, 30))))
                spans += _spans(chunk, count, p >= 0.5)
                chunk, size = [], 0
        return pd.DataFrame({"score": np.array(scores, float), "spans": spans})


class _Emissions(dict):
    """Word -> log-odds; a full table takes no new words."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        out = float(sum(self.weights[f] for f in features(word)))
        if len(self) < MEMORY and len(word) <= 100:
            self[word] = out
        return out


def _spans(texts: list, count: np.ndarray, bad: np.ndarray) -> list[list[dict]]:
    out, at = [], 0
    for text, n in zip(texts, count):
        own, spans, near = bad[at:at + n], [], False
        at += n
        if own.any():
            for m, hit in zip(_WORD.finditer(text), own):
                if hit and near:
                    spans[-1]["end"] = m.end()
                elif hit:
                    spans.append({"start": m.start(), "end": m.end()})
                near = bool(hit)
        out.append(spans)
    return out


def toxic_terms(labelled: DataFrame, text_col: str, label_col: str) -> tuple[set[str], int, int]:
    """Strongly toxic words and prefixes over all labelled rows, and the numbers of toxic and clean rows.

    Counts are combined on the map side. At least ``MIN_SHARE`` occurrences per
    toxic document are asked for, so what the driver gathers is bounded by the
    mean document length over that share, whatever the number of rows.
    """
    classes = {r[0]: r[1] for r in labelled.groupBy(label_col).count().collect()}
    n1, n0 = classes.get(1, 0), classes.get(0, 0)
    words = F.array_distinct(F.split(F.lower(F.col(text_col)), r"[^\p{L}\p{N}]+"))
    vocabulary = (labelled.select(F.explode(words).alias("w"), F.col(label_col).alias("y")).where("w <> ''")
                  .groupBy("w").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")))
    vocabulary = stage(vocabulary, "toxic-words")
    terms = F.array(F.col("w"), *[F.when(F.length("w") >= k, F.concat(F.left("w", F.lit(k)), F.lit("*"))) for k in PREFIXES])
    counts = vocabulary.select(F.explode(terms).alias("term"), "t", "c").where("term is not null").groupBy("term").agg(
        F.sum("t").alias("t"), F.sum("c").alias("c"))
    least = max(MIN_SUPPORT, MIN_SHARE * n1)
    strong = counts.where((F.col("t") >= least) & (F.col("t") / max(n1, 1) >= MIN_LIFT * (F.col("c") + 0.5) / max(n0, 1)))
    return {r[0] for r in strong.select("term").collect()}, n1, n0


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, rounds: int = 60, seed: int = 11) -> ToxicityModel:
    """Fit on labelled rows (label 0 or 1; rows with other labels or null texts are left out).

    Word statistics cover all rows. The field is fitted on at most
    ``sample_docs`` whole documents of each class, none longer than
    ``sample_chars``, drawn by a hash of the id; the logistic function on a
    quarter of them that the field has not seen. Without toxic or clean rows
    the model scores every text at the share of toxic rows (0 without rows), and
    so it does when the sample holds no word. A part of the sample without words
    is replaced by the whole sample.
    """
    labelled = labelled.where(F.col(label_col).isin(0, 1) & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(label_col).cast("long").alias("y"))
    terms, n1, n0 = toxic_terms(labelled, "t", "y")
    prior = np.log((n1 + 1e-9) / (n0 + 1e-9)) if n1 or n0 else -30.0
    unfitted = ToxicityModel(np.zeros(BUCKETS), np.zeros((2, 2)), np.zeros(2), np.array([0, 0, 0, float(np.clip(prior, -30, 30))]))
    if not n1 or not n0:
        return unfitted
    # A hash threshold first, so that no ordering sees more than about twice the sample.
    place = F.pmod(F.xxhash64("i", F.lit(seed)), F.lit(1_000_000))
    near = labelled.where(F.length("t") <= sample_chars).withColumn("h", place)
    rows = []
    for y, n in ((1, n1), (0, n0)):
        rows += near.where((F.col("y") == y) & (F.col("h") < int(min(1.0, 2 * sample_docs / n) * 1_000_000))).orderBy("h", "i").limit(sample_docs).collect()
    rows = sorted(rows, key=lambda r: (r["h"], str(r["i"])))
    texts, y = [r["t"] for r in rows], np.array([r["y"] for r in rows])
    worded = _layout(texts)[2] > 0
    if not worded.any():
        return unfitted
    check = np.arange(len(texts)) % 4 == 3
    if not worded[~check].any():
        check[:] = False
    model = _fit_field([t for t, c in zip(texts, check) if not c], y[~check], terms, rounds)
    memory = _Emissions(model.weights)
    if not worded[check].any():
        check[:] = True
    some, label = [t for t, c in zip(texts, check) if c], y[check]
    words, first, count = _layout(some)
    p = marginals(np.fromiter(map(memory.__getitem__, words), float, len(words)), first, model.trans, model.start)
    model.head = _logistic(summary(p, count), label, np.where(label == 1, n1 / max(1, (label == 1).sum()), n0 / max(1, (label == 0).sum())))
    return model


def _fit_field(texts: list[str], y: np.ndarray, terms: set[str], rounds: int) -> ToxicityModel:
    words, first, count = _layout(texts)
    codes, kinds = pd.factorize(np.array(words, object))
    feats = np.array([features(w) for w in kinds], int).reshape(len(kinds), -1)
    strong = np.array([bool({w, *[w[:k] + "*" for k in PREFIXES if len(w) >= k]} & terms)
                       for w in map(normal, kinds)], bool).reshape(len(kinds))
    gold = (strong[codes] & np.repeat(y == 1, count)).astype(float)
    weights, theta = np.zeros(BUCKETS), np.zeros(6)  # theta: transitions, start
    theta[:] = np.log([0.9, 0.1, 0.6, 0.4, 0.98, 0.02])
    seen = np.zeros((2, 2))
    inner = ~first[1:]
    np.add.at(seen, (gold[:-1].astype(int)[inner], gold[1:].astype(int)[inner]), 1)
    starts = np.array([(gold[first] == 0).sum(), (gold[first] == 1).sum()], float)
    m, v, tm, tv = np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(6), np.zeros(6)
    scale = 1 / max(1.0, gold.sum())
    for step in range(1, rounds + 1):
        emit = weights[feats].sum(1)[codes]
        p, xi = marginals(emit, first, theta[:4].reshape(2, 2), theta[4:], pairs=True)
        per_kind = np.bincount(codes, gold - p, len(kinds))
        g = np.bincount(feats.ravel(), np.repeat(per_kind, feats.shape[1]), BUCKETS) * scale - 1e-3 * weights
        begun = np.array([(1 - p[first]).sum(), p[first].sum()])
        tg = np.concatenate([(seen - xi).ravel(), starts - begun]) * scale - 1e-3 * theta
        for x, gx, mx, vx in ((weights, g, m, v), (theta, tg, tm, tv)):  # Adam
            mx += 0.1 * (gx - mx)
            vx += 0.02 * (gx * gx - vx)
            x += 0.25 * (mx / (1 - 0.9 ** step)) / (np.sqrt(vx / (1 - 0.98 ** step)) + 1e-6)
    return ToxicityModel(weights, theta[:4].reshape(2, 2), theta[4:], np.zeros(4))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weighted logistic regression by Newton's method, lightly shrunk."""
    w, weight = np.zeros(x.shape[1]), weight / weight.mean()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (y - p)) - 0.05 * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w = w + np.linalg.solve(h, g)
    return w


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5 (null ids: not held out)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic") -> DataFrame:
    """Labelled rows that are not held out: ``id_col, text_col, label_col``.

    A document labelled more than once takes its largest label. Labels are
    broadcast up to a measured ``LABEL_BYTES``, so that the text stays in its scan;
    beyond that both sides are shuffled by id.
    """
    known = stage(labels.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
                  .groupBy(id_col).agg(F.max(label_col).alias(label_col)), "toxic-labels")
    known = F.broadcast(known) if fits_broadcast(known, 24, LABEL_BYTES) else known
    return docs.select(id_col, text_col).join(known, id_col)
