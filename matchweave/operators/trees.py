"""A random forest grown from counts of binned rows, level by level, as an MLlib model.

The method is that of MLlib's forest: bins by quantiles, a Poisson bag of the rows for each tree, a draw of features for each node, the
split of most gain in Gini impurity, twin leaves merged. A row is a byte for each feature, written once in blocks; a task visits the rows of a
tree together, in arrays, and holds the counts of one tree at a time. The bag of a block and a tree is drawn again from its seed wherever it is needed, so it takes
no memory and does not depend on where a task runs. Counts are whole numbers; the weights of the classes are applied to their sums.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from matchweave.session import scratch_path, stage

#: Rows of a block, and those a task sorts at once; points that it sends of a feature's distribution, and those it holds meanwhile.
BLOCK_ROWS, SORTED_ROWS, POINTS, HELD_POINTS = 65_536, 100_000, 1_024, 16_384
#: Deepest forest whose counts of one tree stay small (3 MB for ten levels, three classes and four features); most bins that a byte holds.
DEEPEST, MOST_BINS = 10, 256
#: A child as pure as this is not split.
PURE = 1e-16

#: Bag counts of the 2^16 equal parts of the unit interval: Poisson with mean 1.
_poisson = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
_BAG = np.searchsorted(_poisson, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def _bag(seed: int, block: int, tree: int, rows: int) -> np.ndarray:
    """How often each row of a block is in the bag of a tree."""
    draws = np.random.Generator(np.random.SFC64([seed & (2**64 - 1), block, tree]))
    return _BAG[draws.integers(0, 1 << 16, rows, dtype=np.uint16)]


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Labels and features, a row of the matrix for each row of a batch (label, x)."""
    labels = batch.column("label").to_numpy().astype(np.int64)
    values = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return labels, values.reshape(len(labels), -1)


# ---- bins

def _merged(values: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values, kind="stable")
    values, mass = values[order], mass[order]
    cut = np.flatnonzero(np.concatenate((np.ones(min(1, len(values)), bool), values[1:] != values[:-1])))
    return values[cut], np.add.reduceat(mass, cut) if len(cut) else mass


def _thinned(values: np.ndarray, mass: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``points`` of the values at equal steps of mass; each stands for those since the one before."""
    if len(values) <= points:
        return values, mass
    upto = np.cumsum(mass)
    kept = np.unique(np.minimum(np.searchsorted(upto, upto[-1] * np.arange(1, points + 1) / points), len(values) - 1))
    return values[kept], np.diff(upto[kept], prepend=0.0)


def _distributions(weights: np.ndarray, features: int):
    """Each task's values of every feature with their weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [(np.empty(0), np.empty(0))] * features, []

        def add() -> None:
            labels, x = (np.concatenate(part) for part in zip(*waiting))
            for f, (values, mass) in enumerate(held):
                held[f] = _thinned(*_merged(np.concatenate((values, x[:, f])), np.concatenate((mass, weights[labels]))), HELD_POINTS)
            waiting.clear()

        for batch in batches:
            waiting.append(_matrix(batch))
            if sum(len(labels) for labels, _ in waiting) >= SORTED_ROWS:
                add()
        if waiting:
            add()
        held = [_thinned(*own, POINTS) for own in held]
        yield pa.RecordBatch.from_arrays([pa.array(range(features), pa.int32()), pa.array([v.tolist() for v, _ in held], pa.list_(pa.float64())), pa.array([m.tolist() for _, m in held], pa.list_(pa.float64()))], ["feature", "points", "mass"])

    return run


def thresholds_of(values: np.ndarray, mass: np.ndarray, bins: int) -> np.ndarray:
    """Between neighbouring values, all of them or those nearest to equal steps of mass."""
    between = (values[1:] + values[:-1]) / 2
    if len(between) < bins:
        return between
    upto, step = np.cumsum(mass), mass.sum() / bins
    out, target = [], step
    for i, middle in enumerate(between):
        if abs(upto[i] - target) < abs(upto[i + 1] - target):
            out.append(middle)
            target += step
    return np.array(out[: bins - 1])


def _cuts(bins: int):
    """Thresholds of a feature from its distributions in all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for feature, *own in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held.setdefault(feature, []).append([np.array(x, float) for x in own])
        cuts = [thresholds_of(*_merged(*(np.concatenate(part) for part in zip(*own))), bins).tolist() for own in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(cuts, pa.list_(pa.float64()))], ["feature", "cuts"])

    return run


def _thresholds(rows: DataFrame, weights: np.ndarray, features: int, bins: int) -> list[np.ndarray]:
    parts = rows.mapInArrow(_distributions(weights, features), "feature int, points array<double>, mass array<double>").repartition(features, "feature")
    found = {r.feature: np.array(r.cuts, float) for r in parts.mapInArrow(_cuts(bins), "feature int, cuts array<double>").collect()}
    return [found[f] for f in range(features)]


def _blocks(thresholds: list[np.ndarray]):
    """Rows as bytes: bins by row, and labels."""
    def send(number: int, held: list) -> pa.RecordBatch:
        bins, labels = (np.concatenate(part) for part in zip(*held))
        block = (TaskContext.get().partitionId() << 32) + number
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([bins.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary())], ["block", "bins", "labels"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0
        for batch in batches:
            labels, x = _matrix(batch)
            bins = np.stack([np.searchsorted(t, x[:, f]) for f, t in enumerate(thresholds)], axis=1).astype(np.uint8)
            while len(labels):
                take = min(len(labels), BLOCK_ROWS - size)
                held.append((bins[:take], labels[:take].astype(np.uint8)))
                bins, labels, size = bins[take:], labels[take:], size + take
                if size == BLOCK_ROWS:
                    yield send(number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield send(number, held)

    return run


# ---- one level

def _counted(level):
    """Counts of a task's rows by tree: drawn feature, node, bin and class, of the nodes to be split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = level.value
        features, bins_each, classes = now["features"], now["bins"], now["classes"]
        blocks = []
        for batch in batches:
            for number, bins, labels in zip(batch.column("block").to_pylist(), batch.column("bins"), batch.column("labels")):
                blocks.append((number, np.frombuffer(bins.as_buffer(), np.uint8), np.frombuffer(labels.as_buffer(), np.uint8)))
        for tree, (path, slots, drawn) in enumerate(now["trees"]) if blocks else ():
            if not len(drawn):
                continue
            whole = bool((slots >= 0).all())
            total = np.zeros((drawn.shape[1], len(drawn) * bins_each * classes))
            for number, bins, labels in blocks:
                bag = _bag(now["seed"], number, tree, len(labels))
                rows = np.flatnonzero(bag)
                start, node = rows * features, np.zeros(len(rows), np.int64)
                for feature, at in path:
                    node = 2 * node + (bins[start + feature[node]] > at[node])
                slot = slots[node]
                if not whole:
                    inside = slot >= 0
                    rows, start, slot = rows[inside], start[inside], slot[inside]
                cell, times = slot * (bins_each * classes) + labels[rows], bag[rows]
                for j, feature in enumerate(drawn.T):
                    total[j] += np.bincount(cell + bins[start + feature[slot]] * np.int64(classes), times, total.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([total.astype("<i4").tobytes()], pa.binary())], ["tree", "counts"])

    return run


def drawn_features(seed: int, level: int, trees: int, features: int, each: int) -> np.ndarray:
    """The ``each`` features that every place in a level of every tree may be split by."""
    return np.random.default_rng([seed & (2**64 - 1), level]).random((trees, 1 << level, features)).argsort(2)[:, :, :each]


def gini(stats: np.ndarray) -> np.ndarray:
    """Impurity of class weights along the last axis, 0 of none."""
    total = stats.sum(-1)
    return np.where(total > 0, 1 - (stats**2).sum(-1) / np.where(total > 0, total, 1) ** 2, 0.0)


def best_splits(counts: np.ndarray, drawn: np.ndarray, splits: np.ndarray, weights: np.ndarray, least: int, least_gain: float) -> dict[str, np.ndarray]:
    """Of nodes with ``counts`` (drawn feature, node, bin, class): feature (-1: none), last bin to the left, gain and the counts to the left."""
    upto = counts.cumsum(2)
    left, all_ = upto[:, :, :-1], upto[:, :, -1:]
    right = all_ - left
    own, a, b = (c * weights for c in (all_, left, right))
    total = own.sum(-1)
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = gini(own) - a.sum(-1) / total * gini(a) - b.sum(-1) / total * gini(b)
    allowed = (left.sum(-1) >= least) & (right.sum(-1) >= least) & (np.arange(left.shape[2]) < splits[drawn.T][:, :, None])
    gain = np.where(allowed & (gain >= least_gain) & (gain > 0), gain, -np.inf).transpose(1, 0, 2)
    nodes, width = len(gain), gain.shape[2]
    best = gain.reshape(nodes, -1).argmax(1)
    of, at, every = best // width, best % width, np.arange(nodes)
    most = gain[every, of, at]
    found = np.isfinite(most)
    return {"feature": np.where(found, drawn[every, of], -1), "at": at, "gain": np.where(found, most, -1.0), "left": left[of, every, at]}


def _split(level, splits: np.ndarray, weights: np.ndarray, least: int, least_gain: float):
    """The best splits of the trees of a task, from the counts of all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = level.value, {}
        for batch in batches:
            for tree, raw in zip(batch.column("tree").to_pylist(), batch.column("counts")):
                counts = np.frombuffer(raw.as_buffer(), "<i4")
                if tree in sums:
                    sums[tree] += counts
                else:
                    sums[tree] = counts.astype(np.int64)
        for tree, counts in sums.items():
            drawn = now["trees"][tree][2]
            found = best_splits(counts.reshape(drawn.shape[1], len(drawn), now["bins"], now["classes"]), drawn, splits, weights, least, least_gain)
            whole = counts.reshape(drawn.shape[1], len(drawn), -1, now["classes"])[0].sum(1)
            arrays = (found["feature"].astype("<i8"), found["at"].astype("<i8"), found["gain"].astype("<f8"), found["left"].astype("<i8"), whole.astype("<i8"))
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in arrays)], ["tree", "feature", "at", "gain", "lefts", "counts"])

    return run


class _Tree:
    """Nodes of a tree, by level and place in it: counts by class, split feature (-1: leaf), last bin to the left, gain."""

    def __init__(self, classes: int):
        self.counts, self.feature, self.at, self.gain = [], [], [], []
        self.open = np.zeros(1, np.int64)  # places in the level to be split
        self.known = np.zeros((1, classes), np.int64)

    def grow(self, found: tuple | None, classes: int, is_last: bool, weights: np.ndarray, least: int) -> None:
        """Take the splits found for the open nodes and open their children."""
        places = len(self.known)
        feature, at, gain = np.full(places, -1, np.int64), np.full(places, 255, np.int64), np.full(places, -1.0)
        following = np.zeros((2 * places, classes), np.int64)
        if found is not None:
            feature[self.open], at[self.open], gain[self.open], left, self.known[self.open] = found
            at[feature < 0] = 255
            has = found[0] >= 0
            at_ = self.open[has]
            following[2 * at_], following[2 * at_ + 1] = left[has], self.known[at_] - left[has]
        self.counts.append(self.known)
        self.feature.append(feature)
        self.at.append(at)
        self.gain.append(gain)
        self.known = following
        size = following.sum(1)
        # fewer rows than two least leaves have no split
        self.open = np.flatnonzero((size >= max(1, 2 * least)) & (gini(following * weights) >= PURE)) if not is_last else np.zeros(0, np.int64)

    def path(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(np.maximum(f, 0), a) for f, a in zip(self.feature, self.at)]

    def slots(self) -> np.ndarray:
        out = np.full(len(self.known), -1, np.int64)
        out[self.open] = np.arange(len(self.open))
        return out

    def nodes(self, thresholds: list[np.ndarray], weights: np.ndarray) -> list[tuple]:
        """Rows of MLlib's model, the root first, then the left child's nodes; two leaves of one class are their parent."""
        stats = [counts * weights for counts in (*self.counts, self.known)]
        leaves = [[*zip(x.argmax(1).astype(float).tolist(), gini(x).tolist(), x.tolist(), counts.sum(1).tolist())] for x, counts in zip(stats, (*self.counts, self.known))]
        out: list[tuple] = []

        def add(level: int, place: int) -> tuple[bool, float]:
            own, number = leaves[level][place], len(out)
            out.append((number, *own, -1.0, -1, -1, -1, []))
            if level == len(self.feature) or self.feature[level][place] < 0:
                return True, own[0]
            left, second = add(level + 1, 2 * place), len(out)
            right = add(level + 1, 2 * place + 1)
            if left[0] and left == right:
                del out[number + 1 :]
                return True, own[0]
            feature = int(self.feature[level][place])
            out[number] = (number, *own, float(self.gain[level][place]), number + 1, second, feature, [float(thresholds[feature][self.at[level][place]])])
            return False, own[0]

        add(0, 0)
        return out


# ---- the forest

def can_grow(forest: RandomForestClassifier, classes: int) -> bool:
    """Whether ``grown`` knows all that ``forest`` asks for; what it does not is left to MLlib's own training."""
    known = {"numTrees", "maxDepth", "minInstancesPerNode", "minInfoGain", "maxBins", "seed", "maxMemoryInMB", "weightCol", "featuresCol", "labelCol"}
    given = {p.name for p in forest.params if forest.isSet(p)}
    return given <= known and 2 <= classes <= 255 and 1 <= forest.getMaxDepth() <= DEEPEST and forest.getMaxBins() <= MOST_BINS


def grown(rows: DataFrame, forest: RandomForestClassifier, weights: Sequence[float], parts: int) -> RandomForestClassificationModel:
    """The model of ``rows`` (label, features: a vector), ``weights`` by label. Rows are dealt into ``parts`` equal files and read twice."""
    spark, weights = rows.sparkSession, np.array(weights, float)
    plain = rows.select(F.col("label").cast("int").alias("label"), vector_to_array("features").alias("x"))
    features = len(rows.select("features").first()[0])
    trees, depth, classes, seed = forest.getNumTrees(), forest.getMaxDepth(), len(weights), forest.getSeed()
    thresholds = _thresholds(plain, weights, features, forest.getMaxBins())
    splits = np.array([len(t) for t in thresholds])
    blocks = stage(plain.repartition(parts).mapInArrow(_blocks(thresholds), "block bigint, bins binary, labels binary"), "blocos")
    each = features if trees == 1 else math.ceil(math.sqrt(features))
    least, grown_ = forest.getMinInstancesPerNode(), [_Tree(classes) for _ in range(trees)]
    for level in range(depth):
        drawn = drawn_features(seed, level, trees, features, each)
        state = {"seed": seed, "features": features, "classes": classes, "bins": int(splits.max(initial=1)) + 1, "trees": [(t.path(), t.slots(), d[t.open]) for t, d in zip(grown_, drawn)]}
        found: dict[int, tuple] = {}
        if any(len(t.open) for t in grown_):
            sent = spark.sparkContext.broadcast(state)
            counted = blocks.mapInArrow(_counted(sent), "tree int, counts binary").repartition(max(1, min(trees, parts)), "tree")
            for r in counted.mapInArrow(_split(sent, splits, weights, least, forest.getMinInfoGain()), "tree int, feature binary, at binary, gain binary, lefts binary, counts binary").collect():
                whole = (np.frombuffer(r.feature, "<i8"), np.frombuffer(r["at"], "<i8"), np.frombuffer(r.gain, "<f8"))
                found[r.tree] = (*whole, *(np.frombuffer(raw, "<i8").reshape(-1, classes) for raw in (r.lefts, r.counts)))
            sent.unpersist()
        for number, tree in enumerate(grown_):
            tree.grow(found.get(number), classes, level + 1 == depth, weights, least)
    return _model(spark, forest, [t.nodes(thresholds, weights) for t in grown_], features, classes)


def _model(spark, forest: RandomForestClassifier, trees: list[list[tuple]], features: int, classes: int) -> RandomForestClassificationModel:
    """MLlib's model of these nodes, by way of its saved form."""
    path = scratch_path(spark, "floresta")
    params = lambda known: {p.name: v for p, v in known.items()}
    own = {"timestamp": 0, "sparkVersion": spark.version, "paramMap": params(forest._paramMap), "defaultParamMap": params(forest._defaultParamMap)}
    whole = own | {"class": "org.apache.spark.ml.classification.RandomForestClassificationModel", "uid": forest.uid, "numFeatures": features, "numClasses": classes, "numTrees": len(trees)}
    of_tree = {"bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate"}
    single = own | {"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel"} | {m: {k: v for k, v in own[m].items() if k not in of_tree} for m in ("paramMap", "defaultParamMap")}
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    about = [(n, json.dumps(single | {"uid": f"{forest.uid}_{n}"}), 1.0) for n in range(len(trees))]
    spark.createDataFrame(about, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    columns = [*zip(*((n, *node) for n, nodes in enumerate(trees) for node in nodes))]
    kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()))
    table = pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [f"c{i}" for i in range(len(kinds))])
    names = ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild"]
    split = F.struct(F.col("c9").alias("featureIndex"), F.col("c10").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    node = F.struct(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names, 1)], split.alias("split"))
    spark.createDataFrame(table).select(F.col("c0").alias("treeID"), node.alias("nodeData")).coalesce(1).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
