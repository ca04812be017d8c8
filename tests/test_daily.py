"""Two days of the golden season through every stage."""

import pytest

from pyspark.sql import functions as F

from matchweave.plans.daily import Lake, bronze, run_day, run_stage
from matchweave.operators.features import feature_store
from tests import golden


def feeds(spark, scored):
    def one(text, **keys):
        return spark.createDataFrame([(*keys.values(), text)], ", ".join([f"{k} string" for k in keys] + ["payload string"]))

    return {
        "partidas": one(golden.feed_document(golden.games(), scored), competicao="A"),
        "clubes": one(golden.club_document()),
        "atletas": one('{"atletas": [{"atleta_id": 7, "clube_id": 101, "posicao_id": 5, "status_id": 2}]}'),
        "pontuacoes": one('{"atletas": {"7": {"clube_id": 101, "pontuacao": 4.5}, "8": {"clube_id": 102}}}'),
        "status": one('{"rodada": {"rodada_atual": 4}}'),
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")), forest_options={"numTrees": 5, "maxDepth": 3, "minInstancesPerNode": 1})
    lake.first = run_day(lake, feeds(spark, lambda row: row[1] < 5))
    lake.ahead = lake.read("gold.previsoes_proximas_partidas").collect()
    lake.second = run_day(lake, feeds(spark, lambda row: True))
    return lake


def test_all_stages_succeed(lake):
    assert set(lake.first.values()) == set(lake.second.values()) == {"success"}
    runs = lake.read("gold.pipeline_executions").groupBy("stage").count().collect()
    assert {r.stage: r["count"] for r in runs} == dict.fromkeys(lake.first, 2)


def test_clean_tables(lake):
    matches = lake.read("silver.partidas")
    assert matches.count() == 50 and matches.filter("resultado IS NULL").count() == 0
    assert lake.read("bronze.partidas_raw").count() == 100
    assert lake.read("silver.clubes").filter("clube_id = 101").first()["nome"] == "Clube 101"
    scores = {r.atleta_id: (r.rodada, r.posicao_id) for r in lake.read("silver.estatisticas_jogador_partida").collect()}
    assert scores == {7: (4, 5), 8: (4, 0)}


def test_predictions_of_round_five_were_validated(lake):
    assert len(lake.ahead) == 10 and {r.rodada for r in lake.ahead} == {5}
    assert all(abs(r.prob_casa + r.prob_empate + r.prob_visitante - 1) < 1e-9 for r in lake.ahead)
    validated = lake.read("gold.previsoes_validadas")
    assert validated.count() == 10 and validated.filter("acerto = (previsao = resultado_real)").count() == 10
    assert lake.read("gold.mart_desempenho_modelo").first()["total_jogos"] == 10


def test_published_tables(lake, season):
    table = {r.posicao: (r.pontos, r.sg) for r in lake.read("gold.mart_tabela_classificacao").collect()}
    assert table == {row[0]: (row[3], row[9]) for row in golden.table()}
    stored = lake.read("gold.feature_store").drop("competicao")
    assert sorted(map(tuple, stored.collect())) == sorted(tuple(r)[1:] for r in feature_store(season).collect())
    models = lake.read("gold.modelos_registry").collect()
    assert sum(r.ativo for r in models) == 1


def test_checks_were_logged(lake):
    checks = lake.read("gold.data_quality_checks")
    assert checks.filter("status = 'failed'").count() == 0
    names = {r.check_name for r in checks.collect()}
    assert {"not_null_rodada", "unique_partida_id", "accepted_values_resultado", "accepted_range_aproveitamento_pct", "prob_soma_1", "limites_elo_rating"} <= names
    assert {"bronze_partidas_count", "silver_partidas_count", "modelo_acuracia_minima", "inferencia_previsoes"} <= {r.check_name for r in checks.collect()}


def test_views_are_registered(spark, lake):
    assert spark.table("gold_vw_classificacao").count() == 20
    assert spark.table("gold_vw_elo_ranking").count() == 20
    assert spark.table("gold_vw_desempenho_modelo").count() >= 1
    assert spark.table("gold_vw_previsoes").columns[:2] == ["competicao", "rodada"]


def test_features_at_prediction_are_those_of_training(spark, lake, season):
    """Each round as it was ahead: the state after the rounds before gives the rows that training sees later."""
    from matchweave.operators import features, joins
    from matchweave.operators.dataset import training_rows

    trained = {r.partida_id: [round(r[c], 9) for c in joins.FEATURES] for r in training_rows(season, features.model_state(season)).collect()}
    for rodada in range(2, golden.ROUNDS + 1):
        past, coming = season.filter(F.col("rodada") < rodada), season.filter(F.col("rodada") == rodada)
        ahead = joins.features_ahead(coming, features.model_state(past, ahead=True))
        for r in ahead.collect():
            assert [round(r[c], 9) for c in joins.FEATURES] == trained[r.partida_id]


def test_an_empty_day_changes_nothing(spark, lake):
    before = lake.read("silver.partidas").count()
    empty = spark.createDataFrame([("A", '{"partidas": []}')], "competicao string, payload string")
    assert bronze(lake, {"partidas": empty})[1] == 0
    assert lake.read("silver.partidas").count() == before
    warned = lake.read("gold.data_quality_checks").filter("check_name = 'bronze_partidas_count' AND status = 'warning'")
    assert warned.count() == 1


def test_guards_on_a_new_lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "novo"))
    few = feeds(spark, lambda row: row[0] <= 4)
    few["partidas"] = few["partidas"].selectExpr("competicao", f"'{golden.feed_document(golden.games()[:4])}' payload")
    statuses = run_day(lake, few)
    assert statuses["gold_ml_training"] == "skipped" and statuses["gold_ml_inference"] == "skipped"
    reasons = {r.stage: r.error_message for r in lake.read("gold.pipeline_executions").collect()}
    assert reasons["gold_ml_training"] == "Dados insuficientes" and reasons["gold_ml_inference"] == "Modelo nao encontrado"


def test_a_failing_stage_is_recorded_and_raised(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "falha"))

    def broken(_):
        raise RuntimeError("sem conexao")

    with pytest.raises(RuntimeError):
        run_stage(lake, "silver", broken)
    row = lake.read("gold.pipeline_executions").first()
    assert (row.stage, row.status, row.error_message) == ("silver", "failed", "sem conexao")
