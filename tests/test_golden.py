"""The golden season through features, standings, ratings and risk."""

import math

import pytest
from pyspark.sql import functions as F

from matchweave.operators import clubrows as C, elo, features, standings
from tests import golden


@pytest.fixture(scope="module")
def clubs(spark):
    return spark.createDataFrame(
        [(row[1], f"Clube {row[1]}", f"C{row[1]}", "u") for row in golden.table()],
        "clube_id bigint, nome string, abreviacao string, escudo_url string",
    )


def test_outcomes(season):
    counts = {r.resultado: r["count"] for r in season.groupBy("resultado").count().collect()}
    assert counts == golden.outcomes()


def test_table_after_round_five(season, clubs):
    rows = standings.view_standings(features.feature_store(season), clubs).orderBy("posicao").collect()
    found = [
        (r.posicao, r.clube_id, r.jogos, r.pontos, r.vitorias, r.empates, r.derrotas, r.gols_pro, r.gols_contra, r.saldo_gols, r.aproveitamento)
        for r in rows
    ]
    assert found == [row[:-1] for row in golden.table()]


def test_ratings_after_the_last_match(season):
    rated = elo.elo(season)
    score = F.when(F.col("resultado") == "casa", 1.0).when(F.col("resultado") == "empate", 0.5).otherwise(0.0)
    expected = 1 / (1 + F.pow(F.lit(10.0), (F.col("elo_vis") - F.col("elo_casa")) / 400))
    gain = 32 * (score - expected)
    last = rated.filter("rodada = 5").select(
        F.inline(
            F.array(
                F.struct(F.col("clube_casa_id").alias("c"), (F.col("elo_casa") + gain).alias("r")),
                F.struct(F.col("clube_vis_id").alias("c"), (F.col("elo_vis") - gain).alias("r")),
            )
        )
    )
    found = {r.c: round(r.r, 4) for r in last.collect()}
    assert found == {row[1]: row[-1] for row in golden.table()}


def test_rating_mass_is_conserved_each_round(season):
    store = features.features_job(season)
    sums = store.groupBy("rodada").agg(F.sum("elo_rating").alias("s")).collect()
    assert all(abs(r.s - 20 * 1500) < 1e-6 for r in sums)


def test_goals_balance_and_totals_never_fall(season):
    rows = C.club_rows(season)
    assert rows.agg(F.sum("gols_marcados") - F.sum("gols_sofridos")).first()[0] == 0
    store = features.feature_store(season)
    per_club = {}
    for r in store.orderBy("clube_id", "rodada").collect():
        now = (r.pontos_acumulados, r.vitorias, r.empates, r.derrotas, r.gols_marcados, r.gols_sofridos)
        assert all(a >= b for a, b in zip(now, per_club.get(r.clube_id, (0,) * 6)))
        per_club[r.clube_id] = now


def test_risk(season, clubs):
    rows = standings.relegation_risk(features.feature_store(season), clubs).collect()
    for r in rows:
        assert r.prob_rebaixamento == round(1 / (1 + math.exp(-10 * (r.posicao / 20 - 0.85))), 4)
        assert r.zona_rebaixamento == (r.posicao > 16)
        assert r.nome_clube == f"Clube {r.clube_id}"


def test_stepwise_risk(spark):
    places = spark.range(1, 24).selectExpr("cast(id as int) AS posicao")
    found = {r.posicao: (r.prob_rebaixamento, r.zona_rebaixamento) for r in standings.relegation_piecewise(places).collect()}
    assert found[1] == (0.01, False) and found[4] == (0.04, False) and found[5] == (0.04, False)
    assert found[9] == (0.12, False) and found[16] == (0.54, False) and found[17] == (0.65, True)
    assert found[20] == (0.95, True) and found[23] == (0.95, True)


def test_a_club_missing_the_last_round_stays_in_the_mart_only(season, clubs):
    gone = golden.games()[-1]
    short = season.filter(F.col("partida_id") != gone[0])
    store = features.feature_store(short)
    view = standings.view_standings(store, clubs)
    mart = standings.mart_standings(store, clubs, standings.relegation_risk(store, clubs))
    assert {r.clube_id for r in view.collect()} == {row[1] for row in golden.table()} - set(gone[2:4])
    assert mart.count() == 20


def test_doubly_accumulated_goal_difference(spark):
    rows = [(i, i, 1, 10 + i, goals, 0, golden.games()[0][-1]) for i, goals in enumerate((2, 3, 4), start=1)]
    doubled = C.over_clubs(C.club_rows(golden.matches(spark, rows)), C.goal_diff_double(), ["clube_id", "rodada"]).filter("clube_id = 1")
    assert [r.saldo_gols_double for r in doubled.orderBy("rodada").collect()] == [2, 7, 16]


def test_competitions_do_not_mix(spark, season):
    both = season.unionByName(golden.matches(spark, competition="B"))
    for build in (features.feature_store, features.features_job, features.features_sql):
        alone = {tuple(r)[1:] for r in build(season).collect()}
        together = build(both)
        for name in ("A", "B"):
            assert {tuple(r)[1:] for r in together.filter(F.col("competicao") == name).collect()} == alone
