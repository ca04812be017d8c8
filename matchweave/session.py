"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: str = "*", memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A temporary folder stands in only in local mode, where no cluster named one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="matchweave-")
    return _local_folders[context.applicationId]


_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate data, remembered so that ``clear_scratch`` can remove it."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    _written.append(folder)
    return f"{folder}/{name}"


def scratch_mark() -> int:
    return len(_written)


def clear_scratch(spark: SparkSession, since: int = 0, but: int = 0) -> None:
    """Remove the intermediate data written after ``since``, all but the last ``but``; nothing may read it any more."""
    stop = len(_written) - but
    for folder in _written[since:stop]:
        remove(spark, folder)
    del _written[since:stop]


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _file_system(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    system, where = _file_system(spark, path)
    system.delete(where, True)


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``; the old one goes only when the new one stands."""
    system, where = _file_system(spark, path)
    make = spark._jvm.org.apache.hadoop.fs.Path
    old = make(f"{path}.old-{uuid.uuid4().hex}")
    had = system.exists(where)
    if had and not system.rename(where, old):
        raise OSError(f"cannot move {path}")
    if not system.rename(make(new), where):
        if had:
            system.rename(old, where)
        raise OSError(f"cannot put {new} in the place of {path}")
    if had:
        system.delete(old, True)


#: The file that names the valid version of a versioned table, and the beginning of version folders.
POINTER, VERSION = "_atual", "versao-"


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: an atomic rename over the old one, or on an object store, where a rename is a copy, one put."""
    system, where = _file_system(spark, path)
    make = spark._jvm.org.apache.hadoop.fs
    is_store = system.getScheme() in ("s3", "s3a", "s3n", "gs", "abfs", "abfss", "wasb", "oss", "cos")
    to = where if is_store else make.Path(f"{path}.{uuid.uuid4().hex}")
    out = system.create(to, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not is_store:
        options = spark.sparkContext._gateway.new_array(make.Options.Rename, 1)
        options[0] = make.Options.Rename.OVERWRITE
        make.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration()).rename(to, where, options)


def get_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if there is none."""
    system, where = _file_system(spark, path)
    if not system.exists(where):
        return None
    source = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def current(spark: SparkSession, path: str) -> str:
    """The folder to read a table from: its valid version, or the folder itself if it has no versions."""
    version = get_text(spark, f"{path}/{POINTER}")
    return path if version is None else f"{path}/{version}"


def versions(spark: SparkSession, path: str) -> list[str]:
    """Version folders of a table, the oldest first."""
    system, where = _file_system(spark, path)
    if not system.exists(where):
        return []
    found = [(f.getModificationTime(), f.getPath().getName()) for f in system.listStatus(where)]
    return [name for _, name in sorted(found) if name.startswith(VERSION)]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs read the same intermediate result: the lineage ends at
    the files, so neither a second job nor a lost executor recomputes the input.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
