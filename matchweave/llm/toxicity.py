"""Toxic passages as maximal scoring segments of token log-odds, and their significance by extreme-value statistics."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchweave.llm.common import arrow_columns, long
from matchweave.llm.fitting import id_remainder, labelled_sample, logistic, probability
from matchweave.session import stage

#: Labelled rows of each class that the lexicon and the calibration are learned from, together.
PER_CLASS = 8000
#: Share of false tokens that the lexicon may hold, the standard errors a token's log-odds must have in any case, and what every other token costs.
FALSE, CLEAR, DRIFT = 0.01, 2.0, 0.05
#: A word without a score of its own takes that of its longest prefix of so many letters that has one.
PREFIXES = (8, 7, 6, 5)
#: Folds of the sample: each one's texts are scored by the lexicon of the others, for the calibration; pull of its weights to zero.
FOLDS, RIDGE = 5, 0.1
#: Words whose scores a worker remembers before it starts anew.
REMEMBERED = 500_000
#: Expected chance segments in a text below which a segment counts as a passage.
SIGNIFICANT = 0.01

#: A token, for Spark's counts and for the scan.
TOKEN = r"[\p{L}\p{M}]+"
_token = regex.compile(TOKEN)


def tokens(text: str) -> list[str]:
    return _token.findall(text.lower())




def segments(scores: list[tuple[int, float]], gap: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score), in one pass.

    ``scores`` are the places with a score of their own; each other place costs ``gap``. A stack holds
    candidates with the sums before and after them; one that follows a lower start is merged into it.
    """
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, sums before and after, last on the stack with a lower sum before
    done: list[tuple[int, int, float]] = []
    total, at = 0.0, 0
    for place, score in scores:
        total -= gap * (place - at)
        at = place + 1
        before, total = total, total + score
        if score <= 0:
            continue
        start, low, end, high = place, before, place + 1, total
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]  # those between have sums no lower
            if j < 0:  # nothing later can reach further back than here
                done += [(a, b, y - x) for a, b, x, y, _ in stack]
                stack.clear()
                break
            if stack[j][3] >= high:
                break
            start, low = stack[j][0], stack[j][2]
            lower = stack[j][4]
            del stack[j:]
            j = lower
        stack.append((start, end, low, high, j))
    return done + [(a, b, y - x) for a, b, x, y, _ in stack]


@dataclass
class Lexicon:
    """Token scores, the cost of a gap, and the extreme-value law of the best segment in clean text."""

    scores: dict[str, float]
    gap: float
    rate: float = 1.0
    scale: float = 1.0
    weights: tuple = (0.0, 0.0, 0.0)

    def of(self, word: str) -> float | None:
        for key in (word, *(word[:k] + "^" for k in PREFIXES if len(word) > k)):
            if (score := self.scores.get(key)) is not None:
                return score
        return None

    def passages(self, words: list[str]) -> list[tuple[int, int, float]]:
        memory = self.__dict__.setdefault("memory", {})
        for word in set(words).difference(memory):
            memory[word] = self.of(word)
        found = segments([(i, s) for i, s in enumerate(map(memory.__getitem__, words)) if s is not None], self.gap)
        if len(memory) > REMEMBERED:
            memory.clear()
        return found

    def expected(self, score: float, n: int) -> float:
        """Chance segments of at least this score in a clean text of ``n`` tokens."""
        return self.scale * max(n, 1) * math.exp(-self.rate * min(score, 700 / self.rate))

    def weigh(self, scores: list[float], n: int) -> tuple[float, float, int]:
        """Surprise of the best of a text's segments, of all significant ones together, and their number."""
        found = [self.expected(s, n) for s in scores]
        surprise = [max(0.0, -math.log(max(e, 1e-300))) for e in found]
        clear = [x for x, e in zip(surprise, found) if e <= SIGNIFICANT]
        return max(surprise, default=0.0), sum(clear), len(clear)

    def score(self, words: list[str], passages: list[tuple[int, int, float]] | None = None) -> float:
        best, total, _ = self.weigh([s for _, _, s in (self.passages(words) if passages is None else passages)], len(words))
        return probability(self.weights[0] * math.log1p(best) + self.weights[1] * math.log1p(total) + self.weights[2])


def _context_counts(sample: DataFrame) -> DataFrame:
    """(w, clean0, toxic0, clean1, ...): contexts of each token in each fold. Prefixes of words count as tokens, marked ^.

    A token counts once for each pair of neighbours, so copies of a text count as one text.
    """
    words = sample.select("y", "fold", F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0)).alias("w"))
    seen = words.select("y", "fold", F.explode(F.transform("w", lambda x, i: F.struct(x.alias("w"), F.get("w", i - 1).alias("l"), F.get("w", i + 1).alias("r")))).alias("t"))
    seen = seen.select("fold", "y", "t.*").distinct()
    keys = F.array(F.col("w"), *[F.when(F.length("w") > k, F.concat(F.substring("w", 1, k), F.lit("^"))) for k in PREFIXES])
    each = seen.select("fold", "y", F.explode(keys).alias("w")).where(F.col("w").isNotNull())
    count = lambda fold, y: F.sum(((F.col("fold") == fold) & (F.col("y") == y)).cast("double")).alias(f"{('clean', 'toxic')[y]}{fold}")
    return each.groupBy("w").agg(*[count(f, y) for f in range(FOLDS) for y in (0, 1)])


def _lexicon(counts: DataFrame, toxic, clean, n_toxic: float, n_clean: float, weight: dict[int, float]) -> Lexicon:
    """Tokens with clear log-odds; the prior is the token's share of all contexts by the weights of the classes, as strong as the smaller class."""
    if not n_toxic or not n_clean:
        return Lexicon({}, DRIFT, weights=(0.0, 0.0, -2.0))
    strength = min(n_toxic, n_clean)
    prior = (toxic * weight[1] + clean * weight[0]) * (strength / (n_toxic * weight[1] + n_clean * weight[0]))
    logit = lambda count, n: F.log((count + prior) / (F.lit(n + strength) - count - prior))
    odds = logit(toxic, n_toxic) - logit(clean, n_clean)
    error = F.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    some = counts.where(toxic + clean > 0).select("w", odds.alias("s"), (odds / error).alias("z"), (clean / n_clean).alias("p"))
    some = stage(some, "odds")
    top = some.where(F.abs("z") >= clear_from(some)).collect()  # of the words of the sample, whose rows are bounded
    lexicon = Lexicon({r.w: float(r.s) for r in top}, DRIFT)
    # the rate of chance scores: the mean of exp(rate * score) over the tokens of clean text is one
    own = [r for r in top if not r.w.endswith("^")]
    p = np.array([r.p for r in own] + [max(0.0, 1 - sum(r.p for r in own))])
    s = np.array([r.s for r in own] + [-DRIFT])
    low, high = 1e-6, 50.0
    if (p[s > 0] > 0).any() and (p * s).sum() < 0:
        for _ in range(80):
            mid = (low + high) / 2
            low, high = (mid, high) if (p * np.exp(np.clip(mid * s, None, 500))).sum() < 1 else (low, mid)
        lexicon.rate = low
    return lexicon


def clear_from(odds: DataFrame, false: float = FALSE) -> float:
    """The standard errors from which tokens are clear: of those beyond, by chance, a share of ``false`` would be there anyway.

    With few labels the bound falls, so that a small sample has a lexicon too, but not below ``CLEAR``. Spark counts tokens by hundredths.
    """
    steps = odds.groupBy(F.floor(F.least(F.abs("z"), F.lit(40.0)) * 100).alias("step")).count().orderBy(F.desc("step")).collect()
    n, beyond, found = sum(r["count"] for r in steps), 0, math.inf
    for r in steps:
        beyond += r["count"]
        z = r.step / 100
        if z < CLEAR:
            break
        if n * math.erfc(z / math.sqrt(2)) <= false * beyond:
            found = z
    return found


def learn(sample: DataFrame) -> Lexicon:
    """Lexicon from the sample (doc_id, text, y, weight); its calibration from texts that lexicons of the other folds scored.

    Contexts are counted by Spark; of the counts only the clear tokens come to the driver, and of each sampled text the scores of its segments.
    """
    sample = sample.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int"))
    counts = stage(_context_counts(sample), "counts")
    names = [f"{kind}{f}" for f in range(FOLDS) for kind in ("clean", "toxic")]
    n = counts.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in names]).first()
    weight = {0: 1.0, 1: 1.0, **{r.y: r.weight for r in sample.groupBy("y").agg(F.max("weight").alias("weight")).collect()}}

    def of(folds: list[int]) -> Lexicon:
        own = lambda kind: sum((F.col(f"{kind}{f}") for f in folds), F.lit(0.0))
        return _lexicon(counts, own("toxic"), own("clean"), sum(n[f"toxic{f}"] for f in folds), sum(n[f"clean{f}"] for f in folds), weight)

    whole = of(list(range(FOLDS)))
    others = [of([f for f in range(FOLDS) if f != fold]) for fold in range(FOLDS)]
    found = reduce(DataFrame.unionByName, [_raw(sample.where(F.col("fold") == fold), lexicon) for fold, lexicon in enumerate(others)]).toPandas()
    best = [max(x, default=0.0) for x in found.scores]
    for fold, lexicon in enumerate(others):
        clean = [(s, m) for s, m, f, y in zip(best, found.n_words, found.fold, found.y) if f == fold and y == 0 and m > 0]
        if clean:  # the scale that makes the observed maxima of clean texts the expected ones
            lexicon.scale = float(1 / max(np.median([math.exp(-lexicon.rate * min(s, 700 / lexicon.rate)) * m for s, m in clean]), 1e-9))
    whole.rate, whole.scale = (float(np.median([getattr(x, name) for x in others])) for name in ("rate", "scale"))
    raw = np.array([others[f].weigh(s, m)[:2] for s, m, f in zip(found.scores, found.n_words, found.fold)]).reshape(-1, 2)
    whole.weights = tuple(float(x) for x in logistic(np.log1p(raw), found.y.to_numpy(), RIDGE, weight=found.weight.to_numpy()))
    return whole


def _raw(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, y, weight, fold, n_words, scores): the segments' scores of each text."""
    def make():
        def compute(texts):
            split = [tokens(t or "") for t in texts]
            return [[len(w) for w in split], [[s for _, _, s in lexicon.passages(w)] for w in split]]

        return compute

    return arrow_columns(docs.select("doc_id", "y", "weight", "fold", "text"), "text", [long("n_words"), T.StructField("scores", T.ArrayType(T.DoubleType()))], make)


PASSAGE = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType())])


def score_documents(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, score, n_passages, passages) of each row: significant passages by token place, best first by place.

    Null and empty texts have no passages and the score of clean text. Rows repeat as given; an empty table gives none.
    """
    def make():
        def compute(texts):
            scores, numbers, found = [], [], []
            for text in texts:
                words = tokens(text or "")
                n = len(words)
                all_ = lexicon.passages(words)
                own = [(a, b, s, e) for a, b, s in all_ if (e := lexicon.expected(s, n)) <= SIGNIFICANT]
                scores.append(lexicon.score(words, all_))
                numbers.append(len(own))
                found.append([dict(zip(("start", "end", "score", "expected"), p)) for p in own])
            return [scores, numbers, found]

        return compute

    fields = [T.StructField("score", T.DoubleType()), long("n_passages"), T.StructField("passages", T.ArrayType(PASSAGE))]
    return arrow_columns(docs.select("doc_id", "text"), "text", fields, make)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled rows whose id's crc32 is not 1 modulo 3, score every row: adds held_out and predicted (score 0.7 or more).

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; labels are read for the sample alone. A null
    doc_id is not held out. Without labels of both kinds every score is that of clean text.
    """
    lexicon = learn(labelled_sample(docs, labels, "toxic", id_remainder(3) != 1, PER_CLASS))
    scored = score_documents(docs, lexicon)
    held_out = F.coalesce(id_remainder(3) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_passages", "passages")
