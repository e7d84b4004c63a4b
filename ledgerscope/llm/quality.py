"""Quality by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are training rows labelled 1; the unlabelled set is every document
whatever its label. The class prior is estimated from the two score distributions
(best bin: the smallest ratio of unlabelled to positive upper tails, after a first fit
with a discriminating classifier on two folds). A one-hidden-layer network on text
statistics then minimises pi*R_p^+ + max(0, R_u^- - pi*R_p^-) with the sigmoid loss
(Kiryo et al., 2017) and, where the second term turns negative, steps back along it.

Text statistics of all documents are written once, 28 numbers a row; their means and
scales, the tails of the prior and the network come from all of them. The network is
trained where the rows lie: in each round every task steps through all its rows from
the round's weights, and the weights that the tasks reach are averaged by their rows.

Bounded sample: at most ``max_docs`` positives in hash order among those of at most
``max_chars`` characters (documented parameters). Defined cases: null and empty texts
have all-zero features; without positives every score is 0.5; labels that are null, not
0/1 or contradictory are ignored; repeated rows are unlabelled rows each; extra columns stay.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.llm.common import stage, utf8
from ledgerscope.llm.toxicity import fold, texts_of

MAX_DOCS = 6000
MAX_CHARS = 20_000
THRESHOLD = 0.5
HIDDEN = 16
ROUNDS, PRIOR_ROUNDS = 10, 4
STEPS, BATCH = 72, 512  # steps of a task in a round, more where its rows need them; rows of a step
CHUNK = 1 << 16
CUTS = 91
_GROUPS = [bytes(range(48, 58)), bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(128, 256)),
           b" ", b"\n\r", b"\t", b".,;:", b"!?", b"|", b"#$%&*@^~=+<>", b"\"'`", b"()[]{}", b"-_/\\", bytes(range(0, 9))]
_LOOKUP = np.full(256, len(_GROUPS))
for _i, _g in enumerate(_GROUPS):
    _LOOKUP[list(_g)] = _i


def features(text) -> np.ndarray:
    """Shares of byte groups, word repetition, word and line shape of one text."""
    b = utf8(text)
    out = np.zeros(len(_GROUPS) + 12)
    if not b.strip():
        return out
    counts = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    groups = np.bincount(_LOOKUP, weights=counts, minlength=len(_GROUPS) + 1)
    k = len(_GROUPS)
    out[:k + 1] = np.sqrt(groups / len(b))
    words = b.split()
    n = len(words)
    lens = np.fromiter(map(len, words), np.int64, n)
    same = sum(x == y for x, y in zip(words, words[1:]))
    lines = b.split(b"\n")
    m = len(lines)
    out[k + 1:] = [
        len(set(words)) / n ** 0.85, same / n, np.log1p(lens.mean()), np.log1p(lens.std()), np.log1p(n) / 10,
        (lens > 20).mean(), 1 - len(set(lines)) / m, np.log1p(m) / np.log1p(n), sum(w[:1].isupper() for w in words) / n,
        sum(w.isupper() for w in words) / n, sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n]
    return out


def _forward(p, x):
    h = np.tanh(x @ p[0] + p[1])
    return h, h @ p[2] + p[3]


def _start(d: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.r_[rng.normal(0, d ** -0.5, d * HIDDEN), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), 0.0]


def _layers(flat: np.ndarray, d: int) -> list:
    return [flat[:d * HIDDEN].reshape(d, HIDDEN), flat[d * HIDDEN:(d + 1) * HIDDEN], flat[(d + 1) * HIDDEN:-1], flat[-1:]]


def _descend(flat, xp, xu, loss_grad, seed: int, rate: float = 5e-3) -> np.ndarray:
    """Weights after Adam steps from ``flat`` over mini-batches of both sets, each row of ``xu`` at least once;
    loss_grad(zp, zu) gives d risk / d logit of each."""
    rng, d = np.random.default_rng(seed), xp.shape[1]
    p = [q.copy() for q in _layers(flat, d)]
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    ip, iu = rng.permutation(len(xp)), rng.permutation(len(xu))
    for t in range(max(STEPS, -(-len(xu) // BATCH))):
        take = np.arange(t * BATCH, (t + 1) * BATCH)
        x = np.r_[xp[np.take(ip, take, mode="wrap")], xu[np.take(iu, take, mode="wrap")]]
        h, z = _forward(p, x)
        g = np.concatenate(loss_grad(z[:BATCH], z[BATCH:]))
        gh = np.outer(g, p[2]) * (1 - h * h)
        for i, gr in enumerate((x.T @ gh, gh.sum(0), h.T @ g, np.array([g.sum()]))):
            gr = gr + (1e-4 * p[i] if i in (0, 2) else 0)
            m[i] = 0.9 * m[i] + 0.1 * gr
            v[i] = 0.999 * v[i] + 0.001 * gr * gr
            p[i] = p[i] - rate * (m[i] / (1 - 0.9 ** (t + 1))) / (np.sqrt(v[i] / (1 - 0.999 ** (t + 1))) + 1e-8)
    return np.concatenate([q.ravel() for q in p])


def _chunks(batches):
    """(features, fold) of bounded runs of a task's rows."""
    held, size = [], 0
    for pdf in batches:
        held.append(pdf)
        size += len(pdf)
        if size >= CHUNK:
            yield _matrix(held)
            held, size = [], 0
    if size:
        yield _matrix(held)


def _matrix(frames):
    return np.concatenate([np.stack(f["x"].to_numpy()) for f in frames if len(f)]).astype(float), \
        np.concatenate([f["half"].to_numpy() for f in frames if len(f)])


def _scaled(x, mean, scale):
    return np.clip((x - mean) / scale, -8, 8)


def _train(rows: DataFrame, mean, scale, positive: list, loss_grad, rounds: int, seed: int) -> list:
    """One network per entry of ``positive``: a matrix learnt against the unlabelled rows of the entry's half, or of both
    where there is one entry. Rounds of local steps over all rows, averaged by rows; the driver sees one set of weights."""
    d = len(mean)
    nets = [_start(d, seed + k) for k in range(len(positive))]

    def local(r, nets):
        def run(batches):
            for x, half in _chunks(batches):
                x = _scaled(x, mean, scale)
                for k, xp in enumerate(positive):
                    own = x if len(positive) == 1 else x[half == k]
                    if len(own):
                        flat = _descend(nets[k], xp, own, loss_grad, seed * 1000 + 10 * r + k)
                        yield pd.DataFrame({"net": k, "i": np.arange(len(flat)), "n": float(len(own)), "w": flat * len(own)})
        return run
    for r in range(rounds):
        got = (rows.mapInPandas(local(r, nets), "net int, i int, n double, w double").groupBy("net", "i")
               .agg((F.sum("w") / F.sum("n")).alias("w")).toPandas())
        for k in range(len(nets)):
            one = got[got["net"] == k].sort_values("i")
            nets[k] = one["w"].to_numpy() if len(one) else nets[k]
    return nets


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _apart(zp, zu):
    return -(1 - _sigmoid(zp)) / len(zp), _sigmoid(zu) / len(zu)


def estimate_prior(rows: DataFrame, mean, scale, xp, seed: int) -> float:
    """Share of positives among the unlabelled: cross-fitted scores of a positive-versus-unlabelled
    classifier, then the smallest upper bound of unlabelled over positive upper tails. A half
    where either set is too small to split."""
    size = {r.half: r.n for r in rows.groupBy("half").agg(F.count("*").alias("n")).collect()}
    if len(xp) < 2 or len(size) < 2:
        return 0.5
    half = np.arange(len(xp)) % 2
    nets = _train(rows, mean, scale, [xp[half == k] for k in (0, 1)], _apart, PRIOR_ROUNDS, seed)
    d, n = len(mean), sum(size.values())
    sp = np.zeros(len(xp))
    for k in (0, 1):
        sp[half != k] = _forward(_layers(nets[k], d), xp[half != k])[1]
    cuts = np.quantile(sp, np.linspace(0, 0.9, CUTS))

    def tails(batches):
        total = np.zeros(CUTS)
        for x, h in _chunks(batches):
            for k in (0, 1):
                z = np.sort(_forward(_layers(nets[k], d), _scaled(x[h != k], mean, scale))[1])
                total += len(z) - np.searchsorted(z, cuts)
        yield pd.DataFrame({"i": np.arange(CUTS), "n": total})
    got = rows.mapInPandas(tails, "i int, n double").groupBy("i").agg(F.sum("n").alias("n")).toPandas().sort_values("i")
    tail_p, tail_u = np.array([(sp >= c).mean() for c in cuts]), got["n"].to_numpy() / n
    slack = np.sqrt(np.log(40) / 2) * (len(xp) ** -0.5 + n ** -0.5)
    best = np.argmin((tail_u + slack) / tail_p)
    return float(np.clip(tail_u[best] / tail_p[best], 0.02, 0.98))


@F.pandas_udf(T.ArrayType(T.FloatType()))
def _features(texts: pd.Series) -> pd.Series:
    return pd.Series([features(t).astype(np.float32) for t in texts], dtype=object)


def fit(docs: DataFrame, positive: list, seed: int = 7):
    """(mean, scale, network, prior), or None without both sets."""
    if not positive:
        return None
    # Halves of the prior's cross-fit by content, so copies share one.
    rows = stage(docs.select(_features("text").alias("x"), F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(2)).cast("int").alias("half")),
                 "features")
    d = len(features(""))
    moments = rows.select(*[F.col("x")[i].cast("double").alias(f"x{i}") for i in range(d)]).agg(
        F.count("*"), *[F.avg(f"x{i}") for i in range(d)], *[F.stddev_pop(f"x{i}") for i in range(d)]).first()
    if not moments[0]:
        return None
    mean, scale = np.array(moments[1:d + 1], float), np.maximum(np.array(moments[d + 1:], float), 1e-3)
    xp = _scaled(np.array([features(t) for t in positive]), mean, scale)
    pi = estimate_prior(rows, mean, scale, xp, seed)

    def grad(zp, zu):
        lp, lu = _sigmoid(zp), _sigmoid(zu)  # sigmoid loss: l(z, +) = s(-z), l(z, -) = s(z)
        dp, du = lp * (1 - lp) / len(zp), lu * (1 - lu) / len(zu)
        if lu.mean() - pi * lp.mean() >= 0:
            return -2 * pi * dp, du
        return pi * dp, -du  # the negative part went below zero: step back along it

    return mean, scale, _layers(_train(rows, mean, scale, [xp], grad, ROUNDS, seed)[0], d), pi


def scorer(spark, model):
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        net = shared.value
        if net is None or not len(texts):
            return pd.Series(np.full(len(texts), 0.5))
        mean, scale, p, _ = net
        x = _scaled(np.array([features(t) for t in texts]), mean, scale)
        return pd.Series(_sigmoid(_forward(p, x)[1]))
    return score


def quality_scores(docs: DataFrame, labels: DataFrame, out: str = "score",
                   max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> DataFrame:
    """``docs`` plus a score in 0..1."""
    short = (docs.filter(F.col("doc_id").isNotNull() & (F.length(F.coalesce("text", F.lit(""))) <= max_chars))
             .select("doc_id").distinct())
    first = lambda d: [r.doc_id for r in d.orderBy(F.xxhash64(F.col("doc_id"), F.lit(3)), "doc_id").limit(max_docs).collect()]
    trusted = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
               .agg(F.min("quality").alias("__lo")).filter("__lo = 1").filter(fold(F.col("doc_id")) != 1).select("doc_id"))
    positive = [t for _, t in texts_of(docs, first(short.join(trusted, "doc_id", "left_semi")), max_chars)]
    return docs.withColumn(out, scorer(docs.sparkSession, fit(docs, positive))(F.col("text")))
