"""Connectors, guarded writes, upsert, registry and audit."""

from datetime import datetime
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from matchweave.schemas import CHECKS, REGISTRY, RUNS
from matchweave.sources import audit, tables, views
from matchweave import session as session_module


@pytest.fixture
def jdbc(monkeypatch):
    """A DataFrame whose writer records its calls; no database."""
    writer = MagicMock()
    for method in ("format", "mode", "option", "options", "partitionBy"):
        getattr(writer, method).return_value = writer
    df = MagicMock()
    df.observe.return_value.write = writer
    monkeypatch.setattr(tables, "Observation", lambda: MagicMock(get={"rows": 3}))
    monkeypatch.setattr(tables.F, "count", MagicMock())
    monkeypatch.setattr(tables.F, "lit", MagicMock())
    return df, writer


def _options(writer):
    return [call.args for call in writer.option.call_args_list]


def test_jdbc_overwrite_truncates(jdbc):
    df, writer = jdbc
    assert tables.write_table(df, "gold.feature_store", fmt="jdbc", **tables.jdbc_options("jdbc:postgresql://h/d", "u", "p")) == 3
    assert ("truncate", "true") in _options(writer) and ("dbtable", "gold.feature_store") in _options(writer)
    assert writer.options.call_args.kwargs["stringtype"] == "unspecified"
    writer.save.assert_called_once_with()


def test_jdbc_append_does_not_truncate(jdbc):
    df, writer = jdbc
    tables.write_table(df, "bronze.partidas_raw", mode="append", fmt="jdbc")
    assert not [o for o in _options(writer) if o[0] == "truncate"]


def test_jdbc_options():
    plain = tables.jdbc_options("jdbc:postgresql://h/d", "u", "p")
    assert {"user", "password", "driver", "stringtype", "url"} == set(plain)
    split = tables.jdbc_options("jdbc:postgresql://h/d", "u", "p", ("rodada", 1, 38, 8))
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("rodada", "1", "38", "8")


def test_jdbc_read_names_the_table():
    spark = MagicMock()
    reader = spark.read.format.return_value
    reader.option.return_value = reader
    reader.options.return_value = reader
    tables.read_table(spark, "silver.partidas", "jdbc", url="jdbc:x")
    spark.read.format.assert_called_once_with("jdbc")
    reader.option.assert_called_once_with("dbtable", "silver.partidas")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_write_counts_and_reads_back(spark, tmp_path, fmt):
    df = spark.range(25).withColumn("g", F.col("id") % 3)
    path = str(tmp_path / "t")
    assert tables.write_table(df, path, fmt=fmt) == 25
    assert tables.write_table(df, path, fmt=fmt, mode="append") == 25
    assert tables.read_table(spark, path, fmt).count() == 50


def test_partition_overwrite_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, g string"), path, partition_by=["g"])
    tables.write_table(spark.createDataFrame([(9, "b")], "v int, g string"), path, partition_by=["g"])
    assert sorted(tuple(r) for r in tables.read_table(spark, path).collect()) == [(1, "a"), (9, "b")]


def test_empty_batch_keeps_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write_if_nonempty(spark.range(3), path) == 3
    assert tables.write_if_nonempty(spark.range(0), path) == 0
    assert tables.read_table(spark, path).count() == 3
    grown = tables.read_table(spark, path).unionByName(spark.range(3, 5))
    assert tables.write_if_nonempty(grown, path) == 5
    assert tables.read_table(spark, path).count() == 5


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "A"), (2, "B"), (3, "C")], "k int, v string")
    assert {tuple(r) for r in tables.upsert(target, source, ["k"]).collect()} == {(1, "a"), (2, "B"), (3, "C")}


def test_materialize(spark, tmp_path):
    assert tables.materialize(spark.range(4), "gold", "numeros", "view") == "gold_numeros"
    assert spark.table("gold_numeros").count() == 4
    calls = MagicMock()
    df = MagicMock(sparkSession=calls)
    writer = df.write.mode.return_value
    writer.partitionBy.return_value = writer
    assert tables.materialize(df, "silver", "partidas", partition_by=["competicao"]) == "silver.partidas"
    writer.partitionBy.assert_called_once_with("competicao")
    writer.saveAsTable.assert_called_once_with("silver.partidas")


def test_views_and_aliases(spark):
    names = views.register_views({"modelos_registry": spark.range(2), "vw_classificacao": spark.range(3)})
    assert names == ["gold_modelos_registry", "diamond_modelos_registry", "gold_vw_classificacao"]
    assert views.read_view(spark, "diamond_modelos_registry").count() == 2


def test_registry(spark):
    at = [datetime(2026, 3, 20, 18, 0), datetime(2026, 3, 27, 20, 0)]
    metrics = {"acuracia": 0.62341234567, "f1_score": 0.6, "log_loss": 0.8}
    first, second = (audit.new_model(spark, "m", "a", metrics, (4, 5), {"b": 1, "a": 2}, t) for t in at)
    registry = audit.register_model(audit.register_model(spark.createDataFrame([], REGISTRY), first), second)
    assert {(r.versao, r.ativo) for r in registry.collect()} == {("20260320_1800", False), ("20260327_2000", True)}
    assert first.first()["acuracia"] == 0.623412 and first.first()["parametros"] == '{"a": 2, "b": 1}'
    assert audit.active_version(registry).first()[0] == "20260327_2000"
    assert audit.active_version(registry.filter("false")).first()[0] == "unknown"


def test_audit_rows(spark, tmp_path):
    path, t = str(tmp_path / "runs"), datetime(2026, 1, 1)
    assert audit.log_run(spark, path, "silver", "success", t, datetime(2026, 1, 1, 0, 2), records=100)
    row = tables.read_table(spark, path).first()
    assert (row.stage, row.status, row.duration_seconds, row.records_processed) == ("silver", "success", 120, 100)
    assert set(RUNS.names) == set(row.asDict())


def test_a_failing_log_never_fails_the_run(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("x")
    report = spark.createDataFrame([("c", "t", "success", 1, 0, "")], CHECKS)
    assert audit.log_check(report, f"{blocked}/below") is False
    assert audit.log_run(spark, f"{blocked}/below", "silver", "failed", datetime(2026, 1, 1), datetime(2026, 1, 1)) is False


def test_shared_folder_comes_from_the_session():
    spark = MagicMock()
    spark.conf.get.return_value = "s3a://bucket/scratch/"
    assert session_module.shared_folder(spark) == "s3a://bucket/scratch"


def test_no_temporary_folder_on_a_cluster():
    spark = MagicMock()
    spark.conf.get.return_value = None
    spark.sparkContext.master = "yarn"
    with pytest.raises(ValueError):
        session_module.shared_folder(spark)
