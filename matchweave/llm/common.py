"""What the text operators share: words, staged tables, Arrow maps, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchweave.session import stage

#: What separates words in every operator that speaks of words between white space.
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of an Arrow batch; with texts of a hundred kilobytes each a batch stays under a hundred megabytes.
BATCH_ROWS = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once for each row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column, separators: str = SPACES) -> Column:
    """Array of the words of a text, none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def arrow_columns(df: DataFrame, text: str, fields: list[T.StructField], make: Callable[[], Callable[[list], list]], keep_text: bool = False) -> DataFrame:
    """Add columns computed from the text column in Arrow batches; the text goes unless ``keep_text``.

    ``make`` runs once in each task and gives a function from a list of texts (None for null)
    to one list for each field. The other columns pass as they are, so ids keep their type.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    small_batches(df.sparkSession)
    kept = [f for f in df.schema.fields if keep_text or f.name != text]
    at, order = df.columns.index(text), [df.columns.index(f.name) for f in kept]
    names = [f.name for f in kept] + [f.name for f in fields]
    kinds = [_arrow(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            made = compute(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in order] + [pa.array(v, k) for v, k in zip(made, kinds)], names)

    return df.mapInArrow(run, T.StructType(kept + fields))


#: Bytes of text that a function over Arrow batches gets at once; a longer single text comes alone.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes: Spark's own bound is 64 MB, several times over in each worker. Results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, text: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``limit`` bytes of text, or of one row."""
    column = batch.column(text)
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).cumsum()
    at = done = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(sizes.searchsorted(done + limit, side="right")))
        yield batch.slice(at, stop - at)
        at, done = stop, int(sizes[stop - 1])


def bounded_batches(make: Callable[[pa.RecordBatch], pa.RecordBatch], text: str, limit: int = BATCH_BYTES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``make`` over slices of bounded size, for mapInArrow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, limit):
                yield make(part)

    return run


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind.fields])
    return {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(), T.StringType(): pa.string(), T.BooleanType(): pa.bool_(), T.BinaryType(): pa.binary()}[kind]


def long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over undirected ``edges`` (a, b), for every node with an edge.

    Every round links each node's larger neighbours to its smallest one, then its smaller ones too
    (the large-star and small-star steps); the edges end as stars. Each step is one min per node in an
    aggregation and one join on the node, so a hub is pre-aggregated and its join side may be split.
    Rounds follow the logarithm of the longest path. The driver sees only two numbers a round.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        large = _star(now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        now = stage(_star(large, larger=False), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        seen = state


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Of each ``a``, link neighbours ``b`` (the larger, or the smaller ones and ``a`` itself) to the smallest of them and ``a``."""
    if not larger:
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = pairs.join(least, "a")
    if larger:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()
