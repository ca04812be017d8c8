"""Reading and writing tables by connector."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from matchweave.operators.latest import latest_per_key
from matchweave.session import POINTER, VERSION, current, exists, put_text, remove, scratch_path, stage, swap, versions

# Strings reach a JSON column only if the server may cast them.
JDBC_DEFAULTS = {"driver": "org.postgresql.Driver", "stringtype": "unspecified"}


def jdbc_options(
    url: str,
    user: str,
    password: str,
    split_on: tuple[str, int, int, int] | None = None,
) -> dict[str, str]:
    """Connection options; ``split_on`` = (column, lower, upper, partitions) reads in parallel."""
    options = {"url": url, "user": user, "password": password, **JDBC_DEFAULTS}
    if split_on:
        names = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
        options |= {n: str(v) for n, v in zip(names, split_on)}
    return options


def read_table(spark: SparkSession, name: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Scan a table: a path for file formats, ``dbtable`` for JDBC, a name for the catalog."""
    if fmt == "jdbc":
        return spark.read.format("jdbc").option("dbtable", name).options(**options).load()
    if fmt == "table":
        return spark.table(name)
    return spark.read.format(fmt).options(**options).load(name)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    **options: str,
) -> int:
    """Write and return the row count, taken while writing instead of by a second job.

    A JDBC overwrite truncates, so views on the table survive. A file overwrite with
    ``partition_by`` replaces only the partitions present in ``df``.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(fmt).mode(mode).options(**options)
    if fmt == "jdbc":
        writer = writer.option("dbtable", name)
        if mode == "overwrite":
            writer = writer.option("truncate", "true")
        writer.save()
    else:
        if partition_by:
            writer = writer.partitionBy(*partition_by)
            if mode == "overwrite":
                writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.saveAsTable(name) if fmt == "table" else writer.save(name)
    return seen.get["rows"]


FILES = ("parquet", "orc", "json", "csv")


def write_if_nonempty(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet", **options) -> int:
    """Leave the target as it is when the batch has no row.

    A new version of a file table is written once, beside the old one, counted meanwhile, and put in its place
    only if it has rows; so a batch may read the table it replaces, and a failure leaves the old one. An
    append is one write. Other connectors need to know before they truncate: the batch is written to the shared folder first.
    """
    spark = df.sparkSession
    if fmt not in FILES or options.get("partition_by"):
        batch = stage(df, "batch")
        return 0 if batch.isEmpty() else write_table(batch, name, mode, fmt, **options)
    if mode == "append":
        there = exists(spark, name)
        count = write_table(df, name, mode, fmt, **options)
        if not count and not there:
            remove(spark, name)
        return count
    beside = f"{name}.new-{uuid.uuid4().hex}"
    try:
        count = write_table(df, beside, mode, fmt, **options)
        if count:
            swap(spark, beside, name)
    finally:
        remove(spark, beside)
    return count


def replace_table(df: DataFrame, name: str, fmt: str = "parquet", allow_empty: bool = False, **options) -> int:
    """Write ``df`` as the new version of the file table ``name`` and make it the valid one; the number of its rows.

    A version is a folder of its own, and one small file names the valid one, so a reader always finds a whole table and a kill at any
    moment leaves the old one. Nothing is renamed but that file. Readers of the version before go on; those before it are removed. An empty
    ``df`` changes nothing unless ``allow_empty``. ``df`` may read the table. Read with ``read_version``.
    """
    spark, version = df.sparkSession, f"{VERSION}{uuid.uuid4().hex}"
    before = current(spark, name).rpartition("/")[2]
    try:
        count = write_table(df, f"{name}/{version}", fmt=fmt, **options)
    except BaseException:
        remove(spark, f"{name}/{version}")
        raise
    if not count and not allow_empty:
        remove(spark, f"{name}/{version}")
        return 0
    put_text(spark, f"{name}/{POINTER}", version)
    for old in versions(spark, name):
        if old not in (version, before):
            remove(spark, f"{name}/{old}")
    return count


def version_exists(spark: SparkSession, name: str) -> bool:
    """Whether a table has a valid version, or is a plain folder of files."""
    return exists(spark, f"{name}/{POINTER}") or exists(spark, name) and not versions(spark, name)


def read_version(spark: SparkSession, name: str, fmt: str = "parquet", **options) -> DataFrame:
    """The valid version of a table written by ``replace_table``; any other file table as it is."""
    return read_table(spark, current(spark, name), fmt, **options)


def consume(spark: SparkSession, log: str, checkpoint: str, work: Callable[[DataFrame], None]) -> int:
    """Hand ``work`` the rows of the append-only Parquet log ``log`` that no call with ``checkpoint`` has finished; the number of batches.

    A file stream keeps the names of the files read in the checkpoint, so a batch that was begun earlier and committed
    later is read as well, and a second call adds nothing. ``work`` gets rows written beforehand, may read them often, and meets the same
    ones again after a failure, so it has to be a merge.
    """
    done = []

    def batch(rows: DataFrame, number: int) -> None:
        path = scratch_path(spark, "lote")
        rows.write.parquet(path)
        work(spark.read.schema(rows.schema).parquet(path))
        done.append(number)

    schema = spark.read.parquet(log).schema
    stream = spark.readStream.schema(schema).parquet(log).writeStream.foreachBatch(batch)
    stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return len(done)


def upsert_partitions(source: DataFrame, name: str, keys: Sequence[str], partition_by: Sequence[str]) -> int:
    """``upsert`` into the partitioned Parquet table ``name``; the number of rows written.

    Only partitions that hold a key of ``source``, and those its rows belong to, are written, each whole; files of all others stay as they are. A row whose
    partition has changed leaves the old one. Of source rows with one key the greatest stays; null keys are no one's equal.
    A new table is written where there is none.
    """
    spark = source.sparkSession
    once = stage(latest_per_key(source, keys, []), "novas")
    if not exists(spark, name):
        return write_table(once, name, partition_by=partition_by)
    target = spark.read.schema(source.schema).parquet(name)
    held = target.select(*keys, *partition_by).join(once.select(*keys).distinct(), list(keys), "left_semi").select(*partition_by)
    touched = stage(held.union(once.select(*partition_by)).distinct(), "particoes")
    renamed = touched.select(*[F.col(c).alias(f"_p{n}") for n, c in enumerate(partition_by)])
    same = [F.col(c).eqNullSafe(F.col(f"_p{n}")) for n, c in enumerate(partition_by)]
    old = target.join(renamed, same, "left_semi").join(once.select(*keys), list(keys), "left_anti")
    new = stage(old.select(*source.columns).unionByName(once), "particoes_novas")
    # a partition that only gave rows away has none to overwrite it with
    left = touched.join(new.select(*[F.col(c).alias(f"_p{n}") for n, c in enumerate(partition_by)]).distinct(), same, "left_anti")
    count = write_table(new, name, partition_by=partition_by)
    for row in left.toLocalIterator():
        remove(spark, f"{name}/" + "/".join(f"{c}={_folder_value(spark, row[c])}" for c in partition_by))
    return count


def _folder_value(spark: SparkSession, value: object) -> str:
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.DEFAULT_PARTITION_NAME() if value is None or value == "" else utils.escapePathName(str(value).lower() if isinstance(value, bool) else str(value))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; the rest stays. Of source rows with one key the greatest stays."""
    once = latest_per_key(source, keys, [])
    return target.join(once.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(once)


def materialize(df: DataFrame, schema: str, alias: str, kind: str = "table", partition_by: Sequence[str] = ()) -> str:
    """Publish under ``schema.alias`` as a table, or as a session view named ``schema_alias``."""
    if kind == "view":
        name = f"{schema}_{alias}"
        df.createOrReplaceTempView(name)
        return name
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(f"{schema}.{alias}")
    return f"{schema}.{alias}"
