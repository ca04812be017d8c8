"""The forest grown from counts, against growing it plainly and against MLlib's own."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from matchweave.operators import forest, trees
from matchweave.operators.joins import FEATURES

CLASSES = ["casa", "empate", "visitante"]


def season(spark, seed, n, parts=3):
    """Rows whose result follows two of the features, with noise; some features have few values, one has one."""
    dice, rows = random.Random(seed), []
    for _ in range(n):
        x = [float(dice.randint(0, 4)) if f % 3 == 0 else dice.gauss(10, 3) for f in range(len(FEATURES))]
        x[5] = 1.0
        lead = x[0] - 2 + (x[1] - 10) / 3 + dice.gauss(0, 0.4)
        rows.append(("casa" if lead > 0.7 else "visitante" if lead < -0.7 else "empate", *x))
    return spark.createDataFrame(rows, "resultado string, " + ", ".join(f"{f} double" for f in FEATURES)).repartition(parts)


@pytest.fixture
def watched(monkeypatch):
    """What a training staged, its thresholds and its nodes."""
    seen = {}

    def keep(name):
        made = getattr(trees, name)

        def run(*args):
            seen[name, "args"], seen[name] = args, made(*args)
            return seen[name]

        monkeypatch.setattr(trees, name, run)

    for name in ("stage", "_thresholds", "_model"):
        keep(name)
    return seen


def test_training_does_not_visit_rows_in_mllib(spark, monkeypatch):
    def never(*_):
        raise AssertionError("MLlib's training was called")

    monkeypatch.setattr(RandomForestClassifier, "fit", never)
    model = forest.train_forest(season(spark, 1, 300), numTrees=3, maxDepth=3)
    assert isinstance(model, PipelineModel) and model.stages[-1].getNumTrees == 3


@pytest.mark.parametrize(("depth", "least"), [(5, 5), (1, 1), (4, 40)])
def test_same_as_growing_plainly(spark, watched, monkeypatch, depth, least):
    train = season(spark, 2, 700)
    model = forest.train_forest(train, numTrees=6, maxDepth=depth, minInstancesPerNode=least, seed=9)
    blocks, thresholds, nodes = watched["stage"].collect(), watched["_thresholds"], watched["_model", "args"][2]
    assert sum(len(b.labels) for b in blocks) == 700 and len({b.block for b in blocks}) == len(blocks) > 1
    counts = {r.resultado: r["count"] for r in train.groupBy("resultado").count().collect()}
    weights = np.array([700 / (3 * counts[c]) for c in CLASSES])
    bins = np.concatenate([np.frombuffer(b.bins, np.uint8).reshape(-1, len(FEATURES)) for b in blocks])
    labels = np.concatenate([np.frombuffer(b.labels, np.uint8) for b in blocks])
    splits_seen = 0
    for tree, rows in enumerate(nodes):
        bag = np.concatenate([trees._bag(9, b.block, tree, len(b.labels)) for b in blocks])

        def stats(at):
            return np.bincount(labels[at], bag[at], 3)

        def impurity(c):
            return 1 - ((c * weights / (c * weights).sum()) ** 2).sum() if c.sum() else 0.0

        def gain(at, feature, last):
            a, own = at[bins[at, feature] <= last], stats(at)
            left = stats(a)
            right, total = own - left, (own * weights).sum()
            if min(left.sum(), right.sum()) < least:
                return -1.0
            return impurity(own) - (left * weights).sum() / total * impurity(left) - (right * weights).sum() / total * impurity(right)

        def check(number, at, level, place):
            nonlocal splits_seen
            _, answer, own, weighted, count, won, left, right, feature, threshold = rows[number]
            assert weighted == pytest.approx(list(stats(at) * weights)) and count == stats(at).sum()
            assert own == pytest.approx(impurity(stats(at)), abs=1e-12) and answer == np.argmax(weighted)
            if left < 0:
                return
            splits_seen += 1
            drawn = trees.drawn_features(9, level, 6, len(FEATURES), math.ceil(math.sqrt(len(FEATURES))))[tree, place]
            best = max(gain(at, f, k) for f in drawn for k in range(len(thresholds[f])))
            last = int(np.flatnonzero(thresholds[feature] == threshold[0])[0])
            assert feature in drawn and won == pytest.approx(best) and gain(at, feature, last) == pytest.approx(best)
            inside = bins[at, feature] <= last
            check(left, at[inside], level + 1, 2 * place)
            check(right, at[~inside], level + 1, 2 * place + 1)

        check(0, np.arange(len(labels)), 0, 0)
    assert splits_seen >= 6 and all(len(rows) < 2 ** (depth + 1) for rows in nodes)
    # the model decides by the values themselves what was counted by bins
    prepared = train
    for stage in model.stages[:-1]:
        prepared = stage.transform(prepared)
    for r in model.stages[-1].transform(prepared).limit(40).collect():
        votes = np.zeros(3)
        for own in nodes:
            at = own[0]
            while at[6] >= 0:
                at = own[at[6] if r.features[at[8]] <= at[9][0] else at[7]]
            votes += np.array(at[3]) / sum(at[3])
        assert r.probability.toArray() == pytest.approx(votes / 6)


def test_as_good_as_the_training_of_mllib(spark):
    train, test = season(spark, 3, 3000), season(spark, 4, 1500).cache()
    own = forest.model_metrics(forest.train_forest(train, numTrees=25), test)
    other = forest.model_metrics(forest.train_forest(train, numTrees=25, featureSubsetStrategy="sqrt"), test)
    assert own["acuracia"] > 0.7 and own["acuracia"] > other["acuracia"] - 0.03 and own["log_loss"] < other["log_loss"] + 0.05


def test_a_saved_model_predicts_the_same_and_training_repeats(spark, tmp_path):
    train = season(spark, 5, 400).cache()
    model = forest.train_forest(train, numTrees=4)
    model.write().overwrite().save(f"{tmp_path}/m")
    again, twin = PipelineModel.load(f"{tmp_path}/m"), forest.train_forest(train, numTrees=4)
    first, second, third = ([tuple(r.probability.toArray()) for r in m.transform(train).orderBy(*FEATURES).collect()] for m in (model, again, twin))
    assert first == second == third and model.stages[-1].getMaxDepth() == 8
    assert [t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees] == [t.toDebugString.split("\n", 1)[1] for t in again.stages[-1].trees]


def test_what_the_counts_do_not_know_is_left_to_mllib(spark, monkeypatch):
    calls, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: calls.append(1) or fit(self, df))
    train = season(spark, 6, 200)
    for options in ({"impurity": "entropy"}, {"maxDepth": 12}, {"subsamplingRate": 0.5}):
        assert forest.train_forest(train, **({"numTrees": 2} | options)).stages[-1].getNumTrees == 2
    assert len(calls) == 3


def test_odd_training_sets(spark):
    """Rows without a label do not count; equal rows cannot be split; two classes."""
    rows = season(spark, 7, 60)
    same = spark.createDataFrame([("casa", *[1.0] * 14)] * 9 + [("empate", *[1.0] * 14)] * 3 + [(None, *[5.0] * 14)], rows.schema)
    model = forest.train_forest(same, numTrees=2)
    assert [t.numNodes for t in model.stages[-1].trees] == [1, 1] and forest.labels(model) == ["casa", "empate"]
    two = rows.where("resultado <> 'empate'")
    found = forest.score(forest.train_forest(two, numTrees=5), two).agg(F.max("prob_empate"), F.count("*")).first()
    assert found[0] == 0.0 and found[1] == two.count()


def test_thresholds():
    near = lambda x, n: trees.thresholds_of(np.array(x, float), np.array(n, float), 4).tolist()
    assert near([1], [9]) == [] and near([], []) == []
    assert near([1, 2, 5, 9], [1, 50, 1, 1]) == [1.5, 3.5, 7]
    assert near(range(100), [1] * 100) == [24.5, 49.5, 74.5]
    assert near(range(6), [1, 1, 1, 30, 1, 1]) == [2.5, 3.5, 4.5]
    values, mass = np.arange(50_000.0), np.full(50_000, 2.0)
    kept, own = trees._thinned(values, mass, 100)
    assert len(kept) == 100 and own.sum() == 100_000 and abs(kept[49] - 25_000) < 10
    merged = trees._merged(np.array([3.0, 1.0, 3.0]), np.array([1.0, 2.0, 4.0]))
    assert merged[0].tolist() == [1, 3] and merged[1].tolist() == [2, 5]


def test_bags_are_poisson_and_repeat():
    bag = trees._bag(42, 7, 3, 200_000)
    assert (bag == trees._bag(42, 7, 3, 200_000)).all() and not (bag == trees._bag(42, 8, 3, 200_000)).all()
    shares = np.bincount(bag, minlength=6)[:6] / len(bag)
    assert shares == pytest.approx([math.exp(-1) / math.factorial(k) for k in range(6)], abs=0.005) and bag.mean() == pytest.approx(1, abs=0.01)
