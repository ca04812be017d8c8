"""Lloyd's clustering over a VA-file: approximations decide most vectors, full vectors are fetched for the rest.

Each vector has a small approximation, the number of its cell in each dimension. For a set of centroids a lookup
table gives, by dimension and cell, the least and the greatest that a component of the cell can add to the distance to
each centroid; sums over the dimensions are an interval per centroid. What all centroids' distances of a vector have
in common (its distance to the mean centroid) is left out of the tables, which leaves the order of the distances as it is and makes
the intervals several times narrower. Where one centroid's interval lies below all others, the vector's cluster is known without the
vector. Only vectors whose intervals overlap, and those that change their cluster and so the sums, are fetched.

Approximations and vectors are two tables, bucketed by row, so that the vectors never move: a fetch shuffles row numbers.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchweave.session import remove, scratch_path, stage

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Bits of a cell number. Of the vectors of check_l 4 bits leave 98 % undecided, 6 bits 63 %, 8 bits 17 %.
BITS = 8
#: Integers are at most so large, so that squared distances fit 64 bits.
LARGEST = 1 << 27
#: Vectors that the borders of cells are taken from.
SAMPLE = 10_000
#: Vectors of a bucket.
BUCKET = 50_000


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): vectors with exactly ``dimensions`` finite components, each turned into floor(scale * x)."""
    wide = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = wide.where((F.size("v") == dimensions) & F.coalesce(finite, F.lit(False)))
    too_large = F.exists("v", lambda x: F.abs(x * scale) > float(LARGEST))
    checked = F.when(too_large, F.raise_error(F.lit(f"a component is beyond {LARGEST // scale}: squared distances would not fit 64 bits")).cast("array<int>"))
    return kept.select("vec_id", F.coalesce(checked, F.transform("v", lambda x: F.floor(x * scale).cast("int"))).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row, the smaller number at ties, and its squared distance."""
    distance = np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1) if len(x) else np.zeros((0, len(centroids)), np.int64)
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(x)), best]


class Cells:
    """Cell borders by dimension. A component's cell is the number of borders that are not greater than it."""

    def __init__(self, borders: list[list[int]], least: list[int], greatest: list[int]):
        self.borders = [np.unique(np.array(b, np.int64)) for b in borders]
        self.low = [np.concatenate(([lo], b)) for b, lo in zip(self.borders, least)]
        self.high = [np.concatenate((b - 1, [hi])) for b, hi in zip(self.borders, greatest)]

    def of(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(b, x[:, d], side="right") for d, b in enumerate(self.borders)], axis=1).astype(np.uint8)

    def tables(self, centroids: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """By dimension, cell and centroid: least and greatest of (x - c)^2 - (x - m)^2, with m the mean centroid."""
        middle = centroids.sum(axis=0) // len(centroids)
        low, high = [], []
        for d in range(centroids.shape[1]):
            c, m = centroids[:, d], middle[d]
            ends = [c * c - m * m - 2 * edge[:, None] * (c - m) for edge in (self.low[d], self.high[d])]
            low.append(np.minimum(*ends))
            high.append(np.maximum(*ends))
        return low, high

    @staticmethod
    def decide(cells: np.ndarray, tables: tuple[list[np.ndarray], list[np.ndarray]]) -> np.ndarray:
        """The centroid whose interval lies below all others, -1 where intervals overlap."""
        low = sum(t[cells[:, d]] for d, t in enumerate(tables[0]))
        high = sum(t[cells[:, d]] for d, t in enumerate(tables[1]))
        best = high.argmin(axis=1)
        others = low.copy()
        others[np.arange(len(cells)), best] = np.iinfo(np.int64).max
        return np.where(high[np.arange(len(cells)), best] < others.min(axis=1), best, -1)


def _arrays(frame: DataFrame, schema: str, make: Callable[[pa.RecordBatch], list], names: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(make(batch), names)

    return frame.mapInArrow(run, schema)


def cell_borders(v: DataFrame, dimensions: int, bits: int) -> Cells:
    """Borders at the quantiles of ``SAMPLE`` vectors of the least hash, between the least and the greatest of all vectors.

    Borders say how narrow the intervals are, not what they decide, so a bounded sample does.
    """
    sample = v.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("v").collect()
    borders = np.quantile(np.array([r.v for r in sample], np.int64), np.arange(1, 1 << bits) / (1 << bits), axis=0, method="lower")

    def ends(batch: pa.RecordBatch) -> list:
        x = _matrix(batch.column("v"), dimensions)
        return [pa.array(np.arange(dimensions), pa.int32()), pa.array(x.min(axis=0)), pa.array(x.max(axis=0))]

    ranges = _arrays(v.select("v"), "d int, least bigint, greatest bigint", ends, ["d", "least", "greatest"])
    rows = ranges.groupBy("d").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest")).orderBy("d").collect()
    return Cells(list(borders.T), [r.least for r in rows], [r.greatest for r in rows])


def _bucketed(df: DataFrame, buckets: int, folder: str) -> tuple[str, DataFrame]:
    """Write as a table bucketed by row in the shared folder; gives its name and the table."""
    spark, name = df.sparkSession, f"va_{uuid.uuid4().hex}"
    df.repartition(buckets, "row").write.bucketBy(buckets, "row").sortBy("row").format("parquet").option("path", f"{folder}/{name}").saveAsTable(name)
    return name, spark.table(name)


OUT = "row bigint, cluster int, sums array<bigint>"


def _moves(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Exact clusters of fetched vectors (row, v, old), and at a task's end, in lines without a row, what clusters gain and lose by them: sums, then vectors."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gained = np.zeros((k, width + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, old = _matrix(batch.column("v"), width), batch.column("old").to_numpy()
            new, _ = nearest(x, centroids)
            for sign, at in ((1, new), (-1, old)):
                for c in range(k):
                    rows = (at == c) & (new != old)
                    gained[c, :width] += sign * x[rows].sum(axis=0)
                    gained[c, width] += sign * rows.sum()
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(new, pa.int32()), pa.nulls(len(x), pa.list_(pa.int64()))], ["row", "cluster", "sums"])
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.array(np.arange(k), pa.int32()), pa.array(gained.tolist(), pa.list_(pa.int64()))], ["row", "cluster", "sums"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of (cluster, sums) added up in whole numbers of any size, as text."""
    total: dict[int, list[int]] = {}
    for batch in batches:
        for cluster, sums in zip(batch.column("cluster").to_pylist(), batch.column("sums").to_pylist()):
            total[cluster] = [a + b for a, b in zip(total[cluster], sums)] if cluster in total else sums
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([",".join(map(str, x)) for x in total.values()], pa.string())], ["cluster", "sums"])


def _gains(out: DataFrame, k: int, dimensions: int) -> list[list[int]]:
    """What each cluster gains, by dimension and last in vectors: one line for each cluster comes to the driver."""
    gained = [[0] * (dimensions + 1) for _ in range(k)]
    lines = out.where("row IS NULL").select("cluster", "sums").repartition("cluster").mapInArrow(_added, "cluster int, sums string")
    for r in lines.collect():
        gained[r.cluster] = [int(x) for x in r.sums.split(",")]
    return gained


def clusters(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED, bits: int = BITS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept row of ``vectors`` (vec_id, embedding).

    Vectors without exactly ``dimensions`` finite components are left out; the ``k`` starting centroids are those of the least sha256 of
    ``seed:vec_id`` (fewer if there are fewer vectors; a null id comes last; equal ids by their vectors). All numbers are exact integers. Of equal distances the
    smaller cluster number counts, and an empty cluster keeps its centroid. Repeated rows repeat and count as often; an empty table gives none;
    other columns are not read. A component beyond 131,072 is an error, as squared distances would not fit 64 bits.
    """
    spark: SparkSession = vectors.sparkSession
    kept = stage(integer_vectors(vectors, dimensions, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = kept.orderBy(key.asc_nulls_last(), "v").limit(k).select("v").collect()
    centroids = np.array([r.v for r in start], np.int64).reshape(-1, dimensions)
    k = len(centroids)
    if not k:
        return spark.createDataFrame([], f"vec_id {dict(vectors.dtypes)['vec_id']}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    cells = cell_borders(kept, dimensions, bits)
    buckets = max(-(-kept.count() // BUCKET), spark.sparkContext.defaultParallelism)
    folder = scratch_path(spark, "va")
    full_name, full = _bucketed(kept.select("row", "vec_id", "v"), buckets, folder)
    approximate = _arrays(kept.select("row", "v"), "row bigint, cells binary", lambda b: [b.column("row"), pa.array([c.tobytes() for c in cells.of(_matrix(b.column("v"), dimensions))], pa.binary())], ["row", "cells"])
    small_name, small = _bucketed(approximate, buckets, folder)

    sums = [[0] * (dimensions + 1) for _ in range(k)]
    state: DataFrame | None = None
    for _ in range(rounds):
        if state is None:  # the first sums need every vector
            fetched, sure = full.select("row", "v", F.lit(-1).alias("old")), None
        else:
            tables = cells.tables(centroids)

            def decided(batch: pa.RecordBatch, tables=tables) -> list:
                own = np.frombuffer(b"".join(batch.column("cells").to_pylist()), np.uint8).reshape(-1, dimensions)
                return [batch.column("row"), batch.column("old"), pa.array(cells.decide(own, tables), pa.int32())]

            known = small.join(state.select("row", F.col("cluster").alias("old")), "row")
            guess = stage(_arrays(known.select("row", "cells", "old"), "row bigint, old int, cluster int", decided, ["row", "old", "cluster"]), "decided")
            sure = guess.where("cluster = old").select("row", "cluster")
            fetched = full.join(guess.where("cluster <> old").select("row", "old"), "row").select("row", "v", "old")
        out = stage(fetched.mapInArrow(_moves(centroids), OUT), "fetched")
        sums = [[a + b for a, b in zip(x, y)] for x, y in zip(sums, _gains(out, k, dimensions))]
        placed = out.where("row IS NOT NULL").select("row", "cluster")
        state = placed if sure is None else placed.union(sure)
        before = centroids
        centroids = np.array([[s // x[-1] for s in x[:-1]] if x[-1] else c.tolist() for x, c in zip(sums, centroids)], np.int64)
        if (before == centroids).all():
            break  # further rounds change nothing

    def last(batch: pa.RecordBatch) -> list:
        cluster, distance = nearest(_matrix(batch.column("v"), dimensions), centroids)
        return [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)]

    # the distances themselves need every vector once more
    kind = dict(vectors.dtypes)["vec_id"]
    done = stage(_arrays(full.select("vec_id", "v"), f"vec_id {kind}, cluster int, distance bigint", last, ["vec_id", "cluster", "distance"]), "clusters")
    for name in (full_name, small_name):
        spark.sql(f"DROP TABLE {name}")
    remove(spark, folder)
    total = {r.cluster: int(r.d) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    about = [(c, total.get(c, 0), sum(total.values()), hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest()) for c, x in enumerate(centroids)]
    by_cluster = spark.createDataFrame(about, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return done.join(F.broadcast(by_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
