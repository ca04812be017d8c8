"""Checks on data that breaks each rule, and evaluation on small inputs."""

import math

import pytest
from pyspark.sql import functions as F

from matchweave.operators import accuracy as A, quality as Q, reads as R
from matchweave.schemas import CHECKS
from tests import golden


def failures(report):
    assert set(report.columns) == set(CHECKS.names)
    return {r.check_name: (r.status, r.records_checked, r.records_failed) for r in report.collect()}


def test_good_matches_pass(season):
    assert {v[0] for v in failures(Q.dq_match_keys(season)).values()} == {"success"}


def test_bad_matches_are_counted(spark, season):
    bad = spark.createDataFrame([("A", 90, None, 1, 2, 1, 0, "casa"), ("A", 91, *golden.games()[0][1:4], -1, None, "vitoria")],
                                "competicao string, partida_id bigint, rodada int, clube_casa_id bigint, clube_vis_id bigint, placar_casa int, placar_vis int, resultado string")
    found = failures(Q.dq_match_keys(season.unionByName(bad, allowMissingColumns=True)))
    assert found["sem_nulos"] == ("failed", 52, 1) and found["placar_valido"] == ("failed", 52, 1)
    assert found["resultado_valido"][2] == 1 and found["sem_placar"][2] == 1
    assert found["unique_competicao_rodada_clube_casa_id_clube_vis_id"] == ("failed", 51, 1)


def test_counts_ranges_and_values(spark, season):
    assert failures(Q.dq_row_count(season.filter("false"), "t", "vazia"))["vazia"] == ("warning", 0, 0)
    assert failures(Q.dq_predictions(season.filter("false")))["inferencia_previsoes"][0] == "warning"
    df = spark.createDataFrame([(-1.0,), (50.0,), (101.0,), (None,)], "x double")
    assert failures(Q.dq_range(df, "t", "x", 0, 100))["accepted_range_x"] == ("warning", 4, 2)
    assert failures(Q.dq_bounds(df, "t", {"x": (0, None)}))["limites_x"] == ("failed", 4, 1)
    assert failures(Q.dq_not_null(df, "t", ["x"]))["not_null_x"] == ("failed", 4, 1)
    assert failures(Q.dq_accepted(season, "t", "resultado", ["casa"], F.col("rodada") == 1))["accepted_values_resultado"] == ("failed", 10, 10 - golden.outcomes(golden.games()[:10])["casa"])
    assert failures(Q.dq_not_null(df.filter("false"), "t", ["x"]))["not_null_x"] == ("success", 0, 0)


def test_probability_sum(spark):
    df = spark.createDataFrame([(0.5, 0.3, 0.2), (0.5, 0.3, 0.25), (0.5, 0.3, 0.205)], "prob_casa double, prob_empate double, prob_visitante double")
    assert failures(Q.dq_prob_sum(df, "t"))["prob_soma_1"] == ("failed", 3, 1)


def test_positions(spark):
    good = [("A", i) for i in range(1, 21)]
    gap = [("B", i) for i in (1, 2, 4)]
    twice = [("C", i) for i in (1, 1, 3)]
    report = Q.dq_positions(spark.createDataFrame(good + gap + twice, "competicao string, posicao int"))
    assert {r.competicao: r.status for r in report.collect()} == {"A": "success", "B": "failed", "C": "failed"}
    short = Q.dq_positions(spark.createDataFrame(good[:19], "competicao string, posicao int"), expected_clubs=20)
    assert short.first()["status"] == "failed"


def test_positions_with_the_sum_of_a_sequence(spark):
    """A repeat and a gap that leave first, last, count and sum of the places as they should be; a place that is missing."""
    places = {"A": (1, 1, 4, 4, 5), "B": (1, 3, 3, 3, 5), "C": (1, 2, 3, 4, 5), "D": (1, 2, None, 6, 6, 6), "E": (None,)}
    rows = [(c, p) for c, own in places.items() for p in own]
    report = Q.dq_positions(spark.createDataFrame(rows, "competicao string, posicao int"))
    found = {r.competicao: (r.primeira, r.ultima, r.clubes, r.status) for r in report.collect()}
    assert found == {"A": (1, 5, 5, "failed"), "B": (1, 5, 5, "failed"), "C": (1, 5, 5, "success"), "D": (1, 6, 6, "failed"), "E": (None, None, 1, "failed")}


def test_status(spark):
    runs = spark.createDataFrame([("failed",), ("skipped",)], "status string")
    checks = spark.createDataFrame([("failed",), ("success",), ("warning",)], "status string")
    assert failures(Q.dq_status(runs, checks)) == {"sem_falha_critica": ("failed", 3, 1), "alguma_execucao_ok": ("failed", 2, 1)}


@pytest.fixture(scope="module")
def validated(spark):
    rows = [(1, "casa", "casa", 0.55, 0.26, 0.19), (1, "casa", "empate", 0.55, 0.26, 0.19), (2, "empate", "empate", 0.28, 0.45, 0.27), (2, "visitante", "casa", 0.19, 0.26, 0.55)]
    df = spark.createDataFrame([("A", *r) for r in rows], "competicao string, rodada int, previsao string, resultado_real string, prob_casa double, prob_empate double, prob_visitante double")
    return df.withColumn("acerto", F.col("previsao") == F.col("resultado_real"))


def test_performance(validated):
    first, second = A.mart_performance(validated).orderBy("rodada").collect()
    assert (first.acuracia_pct, first.acuracia_casa_pct, first.acuracia_empate_pct, first.acuracia_visitante_pct) == (50.0, 100.0, 0.0, None)
    assert (second.conf_media_acerto, second.conf_media_erro) == (28.0, 19.0)
    assert (second.total_jogos_acumulado, second.acertos_acumulado, second.acuracia_media_5r, second.acuracia_geral_pct) == (4, 2, 50.0, 50.0)


def test_metrics(validated):
    row = A.prediction_metrics(validated).first()
    assert row.acuracia == 0.5
    assert row.log_loss == round(-sum(map(math.log, (0.55, 0.26, 0.45, 0.19))) / 4, 6)
    f1 = {"casa": 2 * 1 / 4, "empate": 2 * 1 / 3}
    assert row.f1_score == pytest.approx((2 * f1["casa"] + 2 * f1["empate"]) / 4, abs=1e-6)
    assert failures(Q.accuracy_gate(A.prediction_metrics(validated)))["modelo_acuracia_minima"] == ("success", 1, 0)
    assert failures(Q.accuracy_gate(A.prediction_metrics(validated.filter("NOT acerto"))))["modelo_acuracia_minima"] == ("warning", 1, 1)


def test_best_round_prefers_the_latest(validated):
    perf = A.mart_performance(validated)
    assert tuple(R.best_round(perf).first()) == ("A", 2, 50.0)
    assert R.confidence_gap(perf).first()["diferenca"] == 9.0


def test_kpis_without_history(spark, validated):
    perf = A.mart_performance(validated)
    ahead = spark.createDataFrame([("B", 1)], "competicao string, id int")
    none = spark.createDataFrame([], "modelo_nome string, versao string, acuracia double, processed_at timestamp_ntz")
    rows = {r.competicao: r for r in R.kpi_summary(perf, ahead, none).collect()}
    assert (rows["A"].acuracia_geral, rows["A"].proximas_partidas, rows["A"].melhor_modelo) == (50.0, 0, None)
    assert (rows["B"].acuracia_geral, rows["B"].proximas_partidas) == (None, 1)
