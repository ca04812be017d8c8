"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad; its score comes from its own measures and those of the lines beside it, and
neighbouring lines' labels from a transition table. Marginals of the forward-backward pass, weighted by line
length, make the document's features; a logistic fit turns them into a probability.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchweave.llm.common import arrow_columns
from matchweave.llm.fitting import id_remainder, labelled_sample, logistic, probability

#: Labelled rows of each class for the fit; all their lines are used.
PER_CLASS = 4000
STEPS, RATE, RIDGE = 150, 0.1, 1e-3
SYMBOLS = "#*$%&|<>"
OWN = 10


def lines(text: str) -> list[list[str]]:
    """Words of each line with any; one line without words for a text without."""
    return [words for line in text.split("\n") if (words := line.split())] or [[]]


def measures(rows: list[list[str]]) -> np.ndarray:
    """Own measures of each line, by share of its words or letters, then the document's repetition up to it."""
    out, seen = [], set()
    for words in rows:
        n = len(words)
        if not n:
            out.append((0.0,) * OWN)
            continue
        joined = "".join(words)
        size = len(joined)
        key = hash(joined)
        again, old = key in seen, len(seen)
        seen.add(key)
        symbols = sum(map(joined.count, SYMBOLS))
        out.append((
            1.0,
            min(6.0, math.log(n)),
            size / n / 10,
            min(2.0, symbols / n),
            sum(map(str.isupper, words)) / n,
            min(2.0, joined.count("!!") / n),
            sum(map(eq, words, words[1:])) / n,
            1 - len(set(words)) / n,
            sum(map(str.isalpha, words)) / n,
            1.0 if again and old else 0.0,
        ))
    return np.array(out)


def features(rows: list[list[str]]) -> np.ndarray:
    """Own measures, the mean of the neighbours' and a constant. The ends have themselves as neighbours."""
    own = measures(rows)
    beside = (np.vstack([own[:1], own[:-1]]) + np.vstack([own[1:], own[-1:]])) / 2
    return np.hstack([own, beside, np.ones((len(own), 1))])


def marginals(emission: list[float], stay: tuple[float, float, float, float]) -> list[float]:
    """Chance that each line is bad. ``emission`` is bad's lead over good, ``stay`` the transition scores (good-good, good-bad, bad-good, bad-bad).

    Messages are kept as the lead of bad over good.
    """
    gg, gb, bg, bb = stay

    def send(lead: float, to_bad: tuple[float, float], to_good: tuple[float, float]) -> float:
        x, y = to_bad[0], lead + to_bad[1]
        u, v = to_good[0], lead + to_good[1]
        top, low = max(x, y), max(u, v)
        return top + math.log1p(math.exp(min(x, y) - top)) - low - math.log1p(math.exp(min(u, v) - low))

    forward, lead = [], 0.0
    for k, e in enumerate(emission):
        lead = e + (send(lead, (gb, bb), (gg, bg)) if k else 0.0)
        forward.append(lead)
    out, back = [0.0] * len(emission), 0.0
    for k in range(len(emission) - 1, -1, -1):
        out[k] = probability(forward[k] + back)
        back = send(emission[k] + back, (bg, bb), (gg, gb))
    return out


@dataclass
class Chain:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    stay: tuple[float, float, float, float]
    final: np.ndarray | None = None
    #: Whether it has learned from labels of both kinds; without them it rejects nothing.
    learned: bool = False

    def document(self, text: str) -> list[float]:
        """Document features: length-weighted bad marginal as a logit, the worst line's, the share of bad length, and size."""
        rows = lines(text)
        emission = ((features(rows) - self.mean) / self.scale) @ self.weights
        bad = np.array(marginals(np.clip(emission, -30, 30).tolist(), self.stay))
        size = np.array([1 + sum(map(len, words)) for words in rows], float)
        share = float((bad * size).sum() / size.sum())
        logit = lambda p: math.log((p + 1e-4) / (1 - p + 1e-4))
        return [logit(share), logit(float(bad.max())), float(size[bad > 0.5].sum() / size.sum()), math.log(size.sum()) / 10]

    def score(self, text: str) -> float:
        return probability(float(np.append(self.document(text), 1.0) @ self.final))


def fit_chain(documents: list[np.ndarray], bad: np.ndarray, steps: int = STEPS) -> Chain:
    """Weights that make the labels of all lines likely, by gradient steps over all sequences at once.

    A document's label stands for each of its lines.
    """
    width = 2 * OWN + 1
    if not documents:
        return Chain(np.zeros(width), np.ones(width), np.zeros(width), (0.0,) * 4)
    flat = np.vstack(documents)
    mean, scale = flat.mean(axis=0), flat.std(axis=0)
    mean[scale == 0], scale[scale == 0] = 0.0, 1.0
    sizes = np.array([len(d) for d in documents])
    order = np.argsort(-sizes)
    sizes, bad = sizes[order], bad[order].astype(float)
    longest = int(sizes[0])
    # lines by their place in the text, at each place those of the documents that reach it, the longest documents first
    there = np.arange(longest)[:, None] < sizes
    alive = there.sum(axis=1)
    first = np.concatenate(([0], np.cumsum(alive)))
    own = np.concatenate([np.arange(n) for n in alive])  # the document of each line
    x = np.empty((int(first[-1]), width))
    for k, i in enumerate(order):
        x[first[: sizes[k]] + k] = (documents[i] - mean) / scale
    y = np.where(bad > 0.5, 1, 0)
    # equal weight for the classes, and for documents whatever their number of lines
    weight = np.where(bad > 0.5, 0.5 / max(bad.sum(), 1), 0.5 / max((1 - bad).sum(), 1)) / sizes
    later = np.arange(first[1], first[-1])  # lines with one before them, and those
    earlier = first[:-1][np.repeat(np.arange(1, longest), alive[1:]) - 1] + own[later] if longest > 1 else later
    w, a = np.zeros(width), np.zeros((2, 2))
    m, v, t = np.zeros(width + 4), np.zeros(width + 4), 0
    for _ in range(steps):
        lead = x @ w
        # messages are the lead of bad over good, as in ``marginals``
        f, b = lead.copy(), np.zeros(len(lead))
        for k in range(1, longest):
            now, before = slice(first[k], first[k + 1]), f[first[k - 1] : first[k - 1] + alive[k]]
            f[now] += np.logaddexp(a[0, 1], before + a[1, 1]) - np.logaddexp(a[0, 0], before + a[1, 0])
        for k in range(longest - 2, -1, -1):
            ahead = slice(first[k + 1], first[k + 2])
            z = lead[ahead] + b[ahead]
            b[first[k] : first[k] + alive[k + 1]] = np.logaddexp(a[1, 0], z + a[1, 1]) - np.logaddexp(a[0, 0], z + a[0, 1])
        p = 1 / (1 + np.exp(-np.clip(f + b, -500, 500)))
        error = (y[own] - p) * weight[own]
        gw = error @ x - RIDGE * w
        ga = np.zeros((2, 2))
        if longest > 1:
            # the chance of each pair of labels: that of the four, made to sum to one
            z = lead[later] + b[later]
            pair = np.stack([np.full(len(later), a[0, 0]), a[0, 1] + z, a[1, 0] + f[earlier], a[1, 1] + f[earlier] + z])
            pair = np.exp(pair - np.logaddexp.reduce(pair, axis=0)) @ weight[own[later]]
            ga = -pair.reshape(2, 2)
            each = np.maximum(sizes - 1, 0) * weight
            ga[0, 0] += each[y == 0].sum()
            ga[1, 1] += each[y == 1].sum()
            ga -= RIDGE * a
        g, t = np.concatenate([gw, ga.ravel()]), t + 1
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, a = w + step[:width], a + step[width:].reshape(2, 2)
    return Chain(mean, scale, w, tuple(float(z) for z in np.clip(a, -3, 3).ravel()))


def learn(sample: DataFrame) -> Chain:
    """Chain from one half of the sample (doc_id, text, y, weight), the final fit from the other half.

    Lines are measured on the executors; the driver gets the measures of all lines of one half of the sampled texts, and four numbers of each of the other.
    """
    sample = sample.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)))
    flat = T.ArrayType(T.DoubleType())

    def make():
        return lambda texts: [[features(lines(t or "")).ravel().tolist() for t in texts]]

    first = arrow_columns(sample.where("half = 0").select("y", "text"), "text", [T.StructField("x", flat)], make).toPandas()
    chain = fit_chain([np.array(x).reshape(-1, 2 * OWN + 1) for x in first.x], 1 - first.y.to_numpy(float))

    def make_documents():
        return lambda texts: [[chain.document(t or "") for t in texts]]

    rest = arrow_columns(sample.where("half = 1").select("y", "weight", "text"), "text", [T.StructField("x", flat)], make_documents).toPandas()
    chain.final = logistic(np.array(rest.x.tolist()).reshape(-1, 4), rest.y.to_numpy(float), weight=rest.weight.to_numpy(float))
    chain.learned = set(rest.y) == {0, 1}
    return chain


def score_documents(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, score) of each row: the chance of label 1."""
    def make():
        return lambda texts: [[chain.score(t or "") for t in texts]]

    return arrow_columns(docs.select("doc_id", "text"), "text", [T.StructField("score", T.DoubleType())], make)


def quality_chain(docs: DataFrame, labels: DataFrame) -> Chain:
    """Chain fitted on labelled rows whose id's crc32 is not 2 modulo 4."""
    return learn(labelled_sample(docs, labels, "quality", id_remainder(4) != 2, PER_CLASS))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; predicted is 1 from a score of 0.7.

    Reads doc_id and text of ``docs``, doc_id and quality of ``labels``. Null and empty texts are one line without
    words; repeated rows repeat; a null doc_id is not held out; an empty table gives none. Without labels every
    score is a half.
    """
    scored = score_documents(docs, quality_chain(docs, labels))
    return scored.select("doc_id", F.coalesce(id_remainder(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
