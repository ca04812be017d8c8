"""Versioned tables, the append log as a stream, upsert by partition, checks counted while writing."""

import os
import random

import pytest
from pyspark.sql import functions as F

from matchweave import session
from matchweave.operators import quality as Q
from matchweave.sources import tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_reader_always_finds_a_whole_table(spark, tmp_path, monkeypatch):
    name = str(tmp_path / "t")
    assert not tables.version_exists(spark, name)
    assert tables.replace_table(spark.range(3), name) == 3
    held = tables.read_version(spark, name)
    grown = held.unionByName(spark.range(10, 12))
    assert tables.replace_table(grown, name) == 5 and held.count() == 3  # the reader of the version before goes on
    # a kill after the files are written and before they are named
    with monkeypatch.context() as m:
        m.setattr(tables, "put_text", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            tables.replace_table(spark.range(100), name)
    assert tables.read_version(spark, name).count() == 5
    # a failing write
    with pytest.raises(Exception):
        tables.replace_table(spark.range(4).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")), name)
    assert tables.read_version(spark, name).count() == 5
    assert tables.replace_table(spark.range(0), name) == 0 and tables.read_version(spark, name).count() == 5
    assert tables.replace_table(spark.range(0), name, allow_empty=True) == 0 and tables.read_version(spark, name).count() == 0
    tables.replace_table(spark.range(7), name)
    assert len(session.versions(spark, name)) == 2 and tables.read_version(spark, name).count() == 7


def test_a_plain_folder_is_read_as_it_is(spark, tmp_path):
    name = str(tmp_path / "t")
    tables.write_table(spark.range(4), name)
    assert tables.version_exists(spark, name) and tables.read_version(spark, name).count() == 4


def test_a_batch_that_began_earlier_and_was_committed_later_is_read(spark, tmp_path):
    log, seen = str(tmp_path / "log"), []
    take = lambda: tables.consume(spark, log, str(tmp_path / "lido"), lambda df: seen.extend(r.id for r in df.collect()))
    early = spark.createDataFrame([(1, 100)], "id int, ingested_at int")
    late = spark.createDataFrame([(2, 200)], "id int, ingested_at int")
    tables.write_table(late, log, mode="append")
    assert take() == 1 and seen == [2]
    tables.write_table(early, log, mode="append")  # begun before the mark, committed after it
    assert take() == 1 and seen == [2, 1]
    assert take() == 0 and seen == [2, 1]


def test_a_failed_merge_meets_its_rows_again(spark, tmp_path):
    log, seen = str(tmp_path / "log"), []
    tables.write_table(spark.range(3), log, mode="append")

    def fails(df):
        raise RuntimeError("lost")

    with pytest.raises(Exception):
        tables.consume(spark, log, str(tmp_path / "lido"), fails)
    tables.consume(spark, log, str(tmp_path / "lido"), lambda df: seen.extend(r.id for r in df.collect()))
    assert sorted(seen) == [0, 1, 2]


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_by_partition(spark, tmp_path, seed):
    dice, name = random.Random(seed), str(tmp_path / "t")
    schema, keys = "k int, v int, g string, h int", ["k"]
    make = lambda n, low, high: [(dice.randrange(low, high), dice.randrange(9), dice.choice(["a", "b x", None, "c/d"]), dice.randrange(2)) for _ in range(n)]
    first = spark.createDataFrame(make(60, 0, 500), schema)
    tables.upsert_partitions(first, name, keys, ["g", "h"])
    whole = tables.upsert(spark.createDataFrame([], schema), first, keys)
    for _ in range(3):
        more = spark.createDataFrame(make(6, 0, 520), schema)
        whole = session.stage(tables.upsert(whole, more, keys), "whole")
        tables.upsert_partitions(more, name, keys, ["g", "h"])
        assert rows(spark.read.schema(schema).parquet(name)) == rows(whole)


def test_upsert_leaves_other_partitions_files(spark, tmp_path):
    name, schema = str(tmp_path / "t"), "k int, v int, g string"
    tables.upsert_partitions(spark.createDataFrame([(k, 0, "abcd"[k % 4]) for k in range(40)], schema), name, ["k"], ["g"])
    before = files(name)
    # key 4 moves from a to b: both are written, c and d are not
    assert tables.upsert_partitions(spark.createDataFrame([(4, 1, "b")], schema), name, ["k"], ["g"]) == 20
    after = files(name)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("g=")[1][0] for f in same} == {"c", "d"} and {f.split("g=")[1][0] for f in before.keys() - same} == {"a", "b"}
    # the only row of a partition moves away: the partition is gone
    tables.upsert_partitions(spark.createDataFrame([(99, 1, "z")], schema), name, ["k"], ["g"])
    tables.upsert_partitions(spark.createDataFrame([(99, 2, "a")], schema), name, ["k"], ["g"])
    assert [tuple(r) for r in spark.read.schema(schema).parquet(name).filter("k = 99").collect()] == [(99, 2, "a")]


def test_checks_counted_while_writing_are_those_of_a_scan(spark, tmp_path):
    df = spark.createDataFrame([(k, None if k % 5 == 0 else k, 300.0 * k) for k in [*range(20), 3, 3]], "id int, a int, elo_rating double")
    failing = Q.not_null(["a"])
    checks = Q.Observed("t", [("failed", failing), ("warning", Q.in_range("elo_rating", 0, 4000)), ("failed", Q.bounds({"elo_rating": (0, None)}))], [["id"]])
    name = str(tmp_path / "t")
    tables.replace_table(checks.of(df), name)
    plain = Q.union_reports(Q.conditions(df, "t", failing), Q.dq_range(df, "t", "elo_rating", 0, 4000), Q.dq_bounds(df, "t", {"elo_rating": (0, None)}), Q.dq_unique(df, "t", ["id"]))
    assert rows(checks.report(tables.read_version(spark, name)).select(*Q.REPORT)) == rows(plain.select(*Q.REPORT))
