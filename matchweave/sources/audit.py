"""Model registry, saved models, run audit and check log."""

from __future__ import annotations

import json
import logging
import uuid
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from matchweave.schemas import CHECKS, REGISTRY, RUNS
from matchweave.sources.tables import write_table

log = logging.getLogger("matchweave")

STATUSES = ("success", "warning", "failed", "skipped")
UNKNOWN_VERSION = "unknown"
VERSION_FORMAT = "%Y%m%d_%H%M"
METRICS = ("acuracia", "f1_score", "log_loss")


def new_model(
    spark: SparkSession, name: str, algorithm: str, metrics: dict[str, float], rounds: tuple[int, int], params: dict, at: datetime
) -> DataFrame:
    """One registry row. Metrics keep 6 digits, the version is the minute of training."""
    values = (
        name, at.strftime(VERSION_FORMAT), algorithm, *[round(metrics[m], 6) for m in METRICS],
        *rounds, json.dumps(params, sort_keys=True), True, at,
    )
    return spark.createDataFrame([values], REGISTRY)


def register_model(registry: DataFrame, new: DataFrame) -> DataFrame:
    """The registry with ``new`` as its only active row."""
    return registry.withColumn("ativo", F.lit(False)).unionByName(new.withColumn("ativo", F.lit(True)))


def active_version(registry: DataFrame) -> DataFrame:
    """Version of the newest active model, in one row."""
    newest = F.max_by("versao", F.struct("processed_at", "versao"))
    return registry.filter("ativo").agg(F.coalesce(newest, F.lit(UNKNOWN_VERSION)).alias("versao"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_exists(spark: SparkSession, path: str) -> bool:
    """Whether a model was saved there, on whichever file system the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/metadata")
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def run_row(
    spark: SparkSession, stage: str, status: str, started: datetime, finished: datetime, records: int = 0,
    error: str | None = None, pipeline: str = "liga",
) -> DataFrame:
    seconds = int((finished - started).total_seconds())
    row = (uuid.uuid4().hex, pipeline, stage, status, started, finished, seconds, records, error)
    return spark.createDataFrame([row], RUNS)


def append_guarded(rows: DataFrame, name: str, **options) -> bool:
    """Append audit rows; a failure is logged and never fails the run."""
    try:
        write_table(rows, name, mode="append", **options)
        return True
    except Exception as error:
        log.warning("could not write %s: %s", name, error)
        return False


def log_run(spark: SparkSession, name: str, *args, **kwargs) -> bool:
    return append_guarded(run_row(spark, *args, **kwargs), name)


def log_check(report: DataFrame, name: str, **options) -> bool:
    """Append check rows as the quality operators return them."""
    return append_guarded(report.select(*CHECKS.names), name, **options)
