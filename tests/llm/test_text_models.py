"""The line chain and the toxic segments: exact parts against brute force, the rest by held-out accuracy."""

import itertools
import math
import os
import random

import numpy as np
import pytest

from matchweave.llm import crf, fitting, toxicity
from matchweave.llm.common import table
from tests.llm.helpers import ODD, odd

SF_DIR = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality bigint, toxic bigint"


@pytest.mark.parametrize("seed", range(4))
def test_marginals_by_counting_all_labellings(seed):
    dice = random.Random(seed)
    e = [dice.uniform(-3, 3) for _ in range(dice.randint(1, 6))]
    stay = tuple(dice.uniform(-2, 2) for _ in range(4))
    total, bad = 0.0, [0.0] * len(e)
    for y in itertools.product((0, 1), repeat=len(e)):
        weight = math.exp(sum(x for x, label in zip(e, y) if label) + sum(stay[2 * a + b] for a, b in zip(y, y[1:])))
        total += weight
        for k, label in enumerate(y):
            bad[k] += weight * label
    assert crf.marginals(e, stay) == pytest.approx([b / total for b in bad])


def test_neighbours_move_a_line():
    """The same middle line is worse between bad lines than between good ones, by features and by transitions."""
    stay = (1.0, -1.0, -1.0, 1.0)
    assert crf.marginals([-4.0, 0.0, -4.0], stay)[1] < 0.5 < crf.marginals([4.0, 0.0, 4.0], stay)[1]
    assert crf.features([["a"], ["#"], ["b"]])[1].tolist() != crf.features([["!!"], ["#"], ["!!"]])[1].tolist()


def test_long_lines_and_empty_texts():
    assert crf.lines("") == crf.lines(" \n ") == [[]]
    assert sum(map(len, crf.lines("w " * 4500))) == 4500 and len(crf.lines("w " * 4500)) == len(crf.lines("w " * 2001)) == 1


def brute_segments(values):
    """Maximal scoring segments by definition: the best one, then those left and right of it."""
    def best(a, b):
        spans = [(sum(values[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
        spans = [s for s in spans if s[0] > 0]
        if not spans:
            return []
        top = max(spans)
        return best(a, top[3]) + [(top[3], top[4], top[0])] + best(top[4], b)

    return best(0, len(values))


@pytest.mark.parametrize("seed", range(6))
def test_segments_are_all_maximal_ones(seed):
    dice = random.Random(seed)
    gap = 0.5
    own = {i: dice.choice([-2.25, 1.125, 3.0625, 0.8125]) for i in range(16) if dice.random() < 0.6}
    values = [own.get(i, -gap) for i in range(16)]
    found = toxicity.segments(sorted(own.items()), gap)
    assert [(a, b, pytest.approx(s)) for a, b, s in brute_segments(values)] == found


def test_many_segments_take_linear_time():
    import time

    dice = random.Random(3)
    scores = [(i, dice.choice([1.5, 2.0, -1.9, -1.6])) for i in range(500_000)]
    start = time.perf_counter()
    found = toxicity.segments(scores, 0.05)
    assert found and time.perf_counter() - start < 20
    falling = toxicity.segments([(2 * i, 1.0) for i in range(200_000)], 5.0)  # each one's start is lower than all before
    assert len(falling) == 200_000


def test_one_definition_of_a_token(spark):
    from pyspark.sql import functions as F

    texts = ["Ünï_code é x1y 漢字 a\u0301b \u0939\u093f\u0902 don't", "a\u200db ⅷ ² ١٢ x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    counted = [r[0] for r in df.select(F.regexp_extract_all(F.lower("t"), F.lit(toxicity.TOKEN), F.lit(0))).collect()]
    assert counted == [toxicity.tokens(t) for t in texts]


def test_the_bound_of_clear_tokens_follows_their_number(spark):
    make = lambda zs: spark.createDataFrame([(float(z),) for z in zs], "z double")
    dice = random.Random(5)
    noise = [dice.gauss(0, 1) for _ in range(3000)]
    assert toxicity.clear_from(make(noise)) > 3.5
    assert 2 <= toxicity.clear_from(make(noise[:50] + [3.2] * 20)) <= 3.2
    assert toxicity.clear_from(make([])) == float("inf")


def sample_tables(spark, seed=1, n=600):
    """Clean and toxic, good and junk texts of invented words."""
    dice = random.Random(seed)
    words = ["".join(dice.choices("abcdefgh", k=5)) for _ in range(300)]
    docs, labels = [], []
    for k in range(n):
        toxic, good = dice.random() < 0.3, dice.random() < 0.7
        text = [dice.choice(words) for _ in range(dice.randint(20, 120))]
        if toxic:
            for _ in range(3):
                text.insert(dice.randrange(len(text)), dice.choice(["vile", "nasty", "rotten"]))
        text = " ".join(text) if good else "\n".join(" ".join(w.upper() + "!!" for w in text[i : i + 9]) for i in range(0, len(text), 9))
        docs.append((k, text))
        labels.append((k, int(good), int(toxic)))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, LABELS), {k: (g, t) for k, g, t in labels}


def test_toxic_documents_are_found_in_held_out_rows(spark):
    docs, labels, truth = sample_tables(spark)
    rows = [r for r in toxicity.toxicity(docs, labels).collect() if r.held_out]
    assert len(rows) > 100 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    wrong = sum(r.predicted != truth[r.doc_id][1] for r in rows)
    assert wrong <= 0.03 * len(rows)
    assert all(r.n_passages == len(r.passages) for r in rows) and any(r.n_passages for r in rows)


def test_quality_of_held_out_rows(spark):
    docs, labels, truth = sample_tables(spark)
    rows = [r for r in crf.quality(docs, labels).collect() if r.held_out]
    assert len(rows) > 80 and sum(r.predicted != truth[r.doc_id][0] for r in rows) <= 0.03 * len(rows)


def test_labels_of_held_out_rows_do_not_matter(spark):
    from pyspark.sql import functions as F

    docs, labels, _ = sample_tables(spark, n=200)
    for run, modulus, rest, label in ((crf.quality, 4, 2, "quality"), (toxicity.toxicity, 3, 1, "toxic")):
        turned = labels.withColumn(label, F.when(fitting.id_remainder(modulus) == rest, 1 - F.col(label)).otherwise(F.col(label)))
        first, second = ({r.doc_id: r.score for r in run(docs, t).collect()} for t in (labels, turned))
        assert first == pytest.approx(second)


@pytest.mark.parametrize("run", [crf.quality, toxicity.toxicity])
def test_odd_tables(spark, run):
    docs, labels, _ = sample_tables(spark, n=120)
    both = docs.unionByName(odd(spark))
    found = run(both, labels).collect()
    assert len(found) == 120 + len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    none = spark.createDataFrame([], LABELS)
    assert run(odd(spark, extra=True), none).count() == len(ODD)
    assert run(odd(spark).limit(0), labels).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_quality_on_the_test_tables(spark):
    truth = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    rows = [r for r in crf.quality(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")).collect() if r.held_out and r.doc_id in truth]
    good = [r for r in rows if truth[r.doc_id] == 1]
    bad = [r for r in rows if truth[r.doc_id] == 0]
    assert sum(r.predicted for r in good) >= 0.97 * len(good)
    assert sum(r.predicted for r in bad) <= 0.2 * len(bad)


def test_logistic_fit():
    dice = np.random.default_rng(0)
    x = dice.normal(size=(4000, 2))
    y = dice.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))
    assert fitting.logistic(x, y.astype(float)) == pytest.approx([2, -1, 0.5], abs=0.25)
    assert fitting.logistic(np.zeros((0, 2)), np.zeros(0)).tolist() == [0, 0, 0]


@pytest.mark.parametrize("module, run, share", [(crf, crf.quality, 0.85), (toxicity, toxicity.toxicity, 0.12)])
def test_a_binding_cap_keeps_the_share_of_the_classes(spark, monkeypatch, module, run, share):
    """Labels that no text explains: every score is near the share of label 1, however few rows are sampled."""
    dice = random.Random(4)
    words = ["".join(dice.choices("abcdefgh", k=5)) for _ in range(40)]
    rows = [(k, " ".join(dice.choices(words, k=30)), int(dice.random() < share)) for k in range(900)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, y, y) for k, _, y in rows], LABELS)
    whole = np.mean([r.score for r in run(docs, labels).collect()])
    monkeypatch.setattr(module, "PER_CLASS", 60)
    capped = np.mean([r.score for r in run(docs, labels).collect()])
    assert whole == pytest.approx(share, abs=0.05) and capped == pytest.approx(whole, abs=0.1)
