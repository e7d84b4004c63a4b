"""Toxicity by class-conditional Kneser-Ney models.

One interpolated Kneser-Ney word model per class: continuation counts (in how
many left contexts the class uses a word) discount into counts shared by both
classes, so an expression that either class has barely seen gets nearly the same
smoothed probability from both and does not tip the score. Higher orders would
only learn near copies of training texts by heart. The score is a logistic
function of the length-normalised log-likelihood ratio, split into the shares of
words that tell against, little, or for toxicity; its parameters are fitted out
of fold on the training rows.

The models are fitted on a bounded sample of labelled rows: at most
``max_docs`` rows per class, taken in hash order among the rows of at most
``max_chars`` characters (documented parameters; scoring covers every row and
whole texts). Defined cases: null and empty texts have no words and score
the text boundary alone; labels with nulls or other values than 0/1 are ignored; a doc_id
labelled twice with both values is used as neither; without both classes every score is the
training rate of label 1 (0 without labels).
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.llm.common import Shipped, utf8

MAX_DOCS = 4000
MAX_CHARS = 20_000
CHUNK = 200_000  # ids worked on at once
THRESHOLD = 0.7
D_SHARED = 0.75
MARKED = 3.0  # log-likelihood ratio from which a word is marked
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text) -> list[bytes]:
    return _WORD.findall(utf8(text).lower())


def fold(id_col):
    """crc32 of the id as text, modulo 3; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3


def training_sample(docs: DataFrame, labels: DataFrame, label: str, max_docs: int, max_chars: int):
    """(vocab, texts, y, rate): the sample's texts per class in hash order as ids of ``vocab``, their
    labels, and the share of label 1 among all training labels. Bounded: 2 * max_docs texts, one number."""
    clean = (labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("__y2")).filter("y = __y2")
             .filter(fold(F.col("doc_id")) != 1).select("doc_id", "y"))
    rate = clean.agg(F.avg("y")).first()[0]
    narrow = docs.select("doc_id").filter(F.length(F.coalesce("text", F.lit(""))) <= max_chars).join(clean, "doc_id").distinct()
    picked = [r for y in (0, 1) for r in narrow.filter(F.col("y") == y)
              .orderBy(F.xxhash64(F.col("doc_id"), F.lit(17)), "doc_id").limit(max_docs).collect()]
    vocab, texts = {}, [None] * len(picked)
    if picked:
        # Arrow holds all texts in a few buffers; only one at a time becomes Python words.
        for batch in _wanted(docs, [r.doc_id for r in picked], max_chars).toArrow().to_batches(1000):
            for at, text in zip(batch.column("at").to_pylist(), batch.column("text")):
                texts[at] = learn(text.as_py(), vocab)
    return vocab, texts, np.array([r.y for r in picked], int), rate


def _wanted(docs: DataFrame, ids: list, max_chars: int) -> DataFrame:
    """(at, text) of the given ids (a bounded list, so they are broadcast and no text is shuffled),
    ``at`` the place in the list; of rows with one id the smallest text."""
    spark = docs.sparkSession
    schema = T.StructType([*docs.select("doc_id").schema.fields, T.StructField("at", T.IntegerType())])
    wanted = F.broadcast(spark.createDataFrame([(i, at) for at, i in enumerate(ids)], schema))
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.length("text") <= max_chars)
            .join(wanted, "doc_id").groupBy("at").agg(F.min("text").alias("text")))


def texts_of(docs: DataFrame, ids: list, max_chars: int) -> list:
    """(doc_id, text) of the given ids, in the list's order."""
    if not ids:
        return []
    found = {r["at"]: r.text for r in _wanted(docs, ids, max_chars).collect()}
    return [(i, found[at]) for at, i in enumerate(ids)]


def learn(text, vocab: dict) -> np.ndarray:
    """The ids of the text's words; new words join ``vocab``. 0: unknown, 1: text boundary."""
    words = words_of(text)
    for w in words:
        if w not in vocab:
            vocab[w] = len(vocab) + 2
    return np.array([vocab[w] for w in words], np.int32)


def _parts(texts: list, words: int = CHUNK):
    """Slices of ``texts`` of about ``words`` ids: a bounded working set."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > words or i == len(texts) - 1:
            yield slice(first, i + 1)
            first, size = i + 1, 0


def _framed(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """All ids with boundaries around each text, and the texts' lengths."""
    lens = np.array([len(t) for t in texts], np.int64)
    ids = np.ones(int(lens.sum()) + len(texts) + 1, np.int64)
    at = 1
    for t in texts:
        ids[at:at + len(t)] = t
        at += len(t) + 1
    return ids, lens


class KneserNey:
    """Class-conditional Kneser-Ney models over words and their ratio per word.

    A class's count of a word is its continuation count: in how many different
    left contexts the class uses it, so one text that repeats itself marks no
    words. It discounts into the shared order, where a word counts once per
    class that uses it. The backoff weight is pooled over both classes, so a
    word that neither has seen cancels out of the ratio."""

    def __init__(self, vocab: dict, texts: list[np.ndarray], y: np.ndarray):
        """``texts``: ids of ``vocab``, which may hold words of other texts: they count as unknown."""
        self.vocab = vocab
        used = np.zeros(len(vocab) + 2, bool)
        for t in texts:
            used[t] = True
        size = int(used.sum()) + 2
        conts = [self._continuations([t for t, k in zip(texts, y) if k == c], len(used)) for c in (0, 1)]
        shared = sum((c > 0).astype(float) for c in conts)
        total, kinds = max(shared.sum(), 1.0), max((shared > 0).sum(), 1)
        lowest = np.maximum(shared - D_SHARED, 0) / total + D_SHARED * kinds / total / size
        seen = np.concatenate([c[c > 0] for c in conts])
        disc = self._discount(seen)
        back = disc * len(seen) / max(seen.sum(), 1.0)
        logs = [np.log(np.maximum(c - disc, 0) / max(c.sum(), 1.0) + back * lowest) for c in conts]
        self.diff = np.where(shared > 0, logs[1] - logs[0], 0.0)

    @staticmethod
    def _continuations(texts, size) -> np.ndarray:
        pairs = np.zeros(0, np.int64)
        for part in _parts(texts, 5 * CHUNK):
            ids, _ = _framed(texts[part])
            pairs = np.union1d(pairs, ids[:-1] * size + ids[1:])
        return np.bincount(pairs % size, minlength=size).astype(float)

    @staticmethod
    def _discount(n) -> float:
        n1, n2 = (n == 1).sum(), (n == 2).sum()
        return n1 / (n1 + 2 * n2) if n1 and n2 else 0.75

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.vocab.get
        return np.array([get(w, 0) for w in words], np.int32)

    def ratio(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log-likelihood ratio per word of each text (its end counts as a word), as the three
        shares that add up to it: words far likelier in ordinary text, words of either, words
        far likelier in toxic text."""
        out = np.zeros((len(texts), 3))
        for part in _parts(texts):
            ids, lens = _framed(texts[part])
            diff = self.diff[ids[1:]]
            first = np.cumsum(np.r_[0, lens[:-1] + 1])
            shares = [np.where(pick, diff, 0.0) for pick in (diff <= -MARKED, np.abs(diff) < MARKED, diff >= MARKED)]
            out[part] = np.stack([np.add.reduceat(x, first) for x in shares], axis=1) / (lens + 1)[:, None]
        return out


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
    """Weighted logistic regression with a weak ridge (Newton steps): (slopes, intercept)."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    a = np.c_[x / scale, np.ones(len(x))]
    beta, ridge = np.zeros(a.shape[1]), np.r_[np.full(x.shape[1], 0.5), 1e-9]
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        g = a.T @ (w * (y - p)) - ridge * beta
        h = (a * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ a + np.diag(ridge)
        step = np.linalg.solve(h, g)
        beta += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return beta[:-1] / scale, float(beta[-1])


def fit(vocab: dict, texts: list[np.ndarray], y: np.ndarray, rate: float | None):
    """(model, slopes, intercept) from the sample's texts as ids of ``vocab``."""
    if rate is None or len(set(y.tolist())) < 2:
        p = min(max(rate or 0.0, 1e-9), 1 - 1e-9)
        return None, np.zeros(3), float(np.log(p / (1 - p)))
    half = np.zeros(len(y), int)
    for c in (0, 1):
        at = np.flatnonzero(y == c)
        half[at] = np.arange(len(at)) % 2
    x = np.zeros((len(y), 3))
    for h in (0, 1):
        other, own = np.flatnonzero(half != h), np.flatnonzero(half == h)
        x[own] = KneserNey(vocab, [texts[i] for i in other], y[other]).ratio([texts[i] for i in own])
    weight = np.where(y == 1, rate / (y == 1).sum(), (1 - rate) / (y == 0).sum()) * len(y)
    slopes, bias = logistic(x, y, weight)
    return KneserNey(vocab, texts, y), slopes, bias


def scorer(spark, model, slopes: np.ndarray, bias: float):
    """Pandas UDF text -> score; the model (bounded by the sample) is broadcast."""
    shared = Shipped(spark, model)

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        kn = shared.value
        out = np.zeros((len(texts), 3))
        if kn is not None:
            held, size, at = [], 0, 0
            for i, t in enumerate(texts):
                held.append(kn.ids(words_of(t)))
                size += len(held[-1])
                if size > CHUNK or i == len(texts) - 1:  # bounded working set
                    out[at:i + 1] = kn.ratio(held)
                    held, size, at = [], 0, i + 1
        return pd.Series(1 / (1 + np.exp(-np.clip(out @ slopes + bias, -700, 700))))
    return score


def toxicity_scores(docs: DataFrame, labelled: DataFrame, labels: DataFrame, out: str = "score",
                    max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> DataFrame:
    """``docs`` plus a score in 0..1; ``labelled`` holds the texts that ``labels`` marks."""
    sample = training_sample(labelled, labels, "toxic", max_docs, max_chars)
    return docs.withColumn(out, scorer(docs.sparkSession, *fit(*sample))(F.col("text")))


def drop_toxic(docs: DataFrame, labelled: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return toxicity_scores(docs, labelled, labels, "__score").filter(F.col("__score") < threshold).drop("__score")
