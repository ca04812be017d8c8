"""What a task holds does not grow with the tables."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchweave.operators import elo, forest
from matchweave.sources import league_from_orders

MATCHES = "competicao string, partida_id bigint, clube_casa_id bigint, clube_vis_id bigint, resultado string, data_partida timestamp_ntz"


def test_ratings_take_a_competition_in_batches(spark, monkeypatch):
    dice = random.Random(3)
    rows = []
    for k in range(300):
        home, away = dice.sample(range(1, 9), 2)
        rows.append((dice.choice(["a", "a", "a", "b", None]), k, home, away, dice.choice([elo.HOME, elo.DRAW, elo.AWAY]), datetime(2024, 1, 1) + timedelta(days=dice.randrange(60))))
    expected, known = {}, {}
    for league, k, home, away, result, _ in sorted(rows, key=lambda r: (r[5], r[1])):
        a, b = (known.get((league, c), elo.START_RATING) for c in (home, away))
        expected[k] = (a, b)
        moved = elo.K_FACTOR * (elo.SCORES[result] - 1 / (1 + 10 ** ((b - a) / elo.SCALE)))
        known[league, home], known[league, away] = a + moved, b - moved
    sizes, rater = spark.sparkContext.accumulator(0), elo._rater

    def watched(k, start):
        rate = rater(k, start)

        def run(matches, ratings):
            sizes.add(int(len(matches) > 10))
            return rate(matches, ratings)

        return run

    monkeypatch.setattr(elo, "_rater", watched)
    most = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        found = {r.partida_id: (r.elo_casa, r.elo_vis) for r in elo.elo(spark.createDataFrame(rows, MATCHES)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
    assert sizes.value == 0 and set(found) == set(expected)
    assert all(found[k] == pytest.approx(expected[k], abs=1e-9) for k in expected)


def test_groups_of_one_match_come_in_one_call(spark):
    """Ratings held before and handed on, of many groups in a batch, a null club and an empty hand-over among them."""
    facts = spark.createDataFrame([(g, "a", g, None, g, 1000 + g, 2000 + g if g else None, elo.DRAW) for g in range(500)], f"_grupo bigint, competicao string, {elo.LINE} bigint, data_partida timestamp_ntz, partida_id bigint, clube_casa_id int, clube_vis_id int, resultado string")
    held = spark.createDataFrame([(7, "a", 1007, 1900.0)], "_grupo bigint, competicao string, _clube bigint, _elo double")
    rows = elo.in_order(facts, ["_grupo", "competicao"], elo.K_FACTOR, elo.START_RATING, held).collect()
    before = {r[elo.LINE]: (r.elo_casa, r.elo_vis) for r in rows if r[elo.LINE] is not None}
    after = {(r._grupo, r._clube): r.elo_casa for r in rows if r[elo.LINE] is None}
    assert len(before) == 500 and before[7] == (1900.0, 1500.0) and before[8] == (1500.0, 1500.0)
    assert len(after) == 999 and after[7, 1007] + after[7, 2007] == pytest.approx(3400) and after[7, 1007] < 1900 and after[9, 1009] == 1500


def test_tasks_of_the_raw_matches_follow_the_lines(spark, tmp_path, monkeypatch):
    when = F.lit("1999-05-04").cast("timestamp_ntz")
    lines = spark.range(2000).select((F.col("id") % 500).alias("l_orderkey"), (F.col("id") % 7).alias("l_suppkey"), F.lit(3.0).alias("l_quantity"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(500).select(F.col("id").alias("o_orderkey"), when.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{tmp_path}/orders.parquet")
    few = {tuple(r) for r in league_from_orders.raw_matches(spark, str(tmp_path)).collect()}
    monkeypatch.setattr(league_from_orders, "LINES", 50)
    many = league_from_orders.raw_matches(spark, str(tmp_path))
    assert many.rdd.getNumPartitions() == 40 and {tuple(r) for r in many.collect()} == few and len(few) == 500


def test_forest_trains_in_equal_tasks(spark, monkeypatch):
    """Tasks follow the cores and then the rows, not the files of the training set, and none holds most rows."""
    monkeypatch.setattr(forest, "TASK_ROWS", 100)
    cores = spark.sparkContext.defaultParallelism
    few = spark.range(0, 10, 1, 50).select(F.col("id").alias("rodada"))
    uneven = spark.range(0, 900 * cores, 1, 3).filter("id >= 300 * 2 OR id % 5 = 0")
    assert forest.spread(few).rdd.getNumPartitions() == cores
    sizes = [len(p) for p in forest.spread(uneven).rdd.glom().collect()]
    assert len(sizes) == max(cores, -(-sum(sizes) // 100)) and max(sizes) <= 2 * 100
