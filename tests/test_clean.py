"""Cleaning rules on small literal inputs."""

import pytest

from matchweave.operators import clean, standings
from matchweave.functions import labels, scoring
from pyspark.sql import functions as F

RAW = (
    "competicao string, partida_id bigint, rodada int, clube_casa_id bigint, clube_vis_id bigint, placar_casa int, "
    "placar_vis int, data_partida timestamp, status string, raw_payload string"
)


def raw(spark, *rows):
    full = [("A", i, *row, None, "", "{}") for i, row in enumerate(rows, start=1)]
    return spark.createDataFrame(full, RAW)


@pytest.mark.parametrize("home", [None, 0, 2, 5])
@pytest.mark.parametrize("away", [None, 0, 2, 4])
def test_result(spark, home, away):
    expected = None
    if home is not None and away is not None:
        expected = "empate" if home == away else "casa" if home > away else "visitante"
    assert clean.with_result(raw(spark, (3, 11, 12, home, away))).first()["resultado"] == expected


def test_unplayed_matches_stay_unless_asked(spark):
    rows = raw(spark, (4, 31, 32, 2, None), (4, 33, 34, None, 0), (4, 35, 36, 4, 4), (5, 31, 36, None, None))
    assert {r.clube_casa_id for r in clean.silver_matches(rows, played_only=True).collect()} == {35}
    assert clean.silver_matches(rows).count() == 4


def test_of_a_repeated_match_the_last_row_stays(spark):
    rows = raw(spark, (2, 21, 22, None, None), (2, 22, 21, 6, 0), (2, 21, 22, 0, 1), (2, 21, 22, 5, 5))
    found = {(r.clube_casa_id, r.clube_vis_id): (r.partida_id, r.placar_casa, r.placar_vis) for r in clean.silver_matches(rows).collect()}
    assert found == {(21, 22): (4, 5, 5), (22, 21): (2, 6, 0)}


def test_matches_without_key_fields_are_dropped(spark):
    rows = raw(spark, (None, 1, 2, 0, 0), (1, None, 2, 0, 0), (1, 1, None, 0, 0), (1, 1, 2, 0, 0))
    assert clean.silver_matches(rows).count() == 1


def test_clubs(spark):
    schema = "id bigint, clube_id int, nome string, abreviacao string, escudo_url string, raw_payload string, ingested_at timestamp"
    names = [(51, "\tNorte  "), (51, "Norte"), (52, "Sul do Vale"), (None, "Sem id"), (53, None)]
    rows = [(n, club, name, f" {name}"[:4], f"e{club}", "{}", None) for n, (club, name) in enumerate(names)]
    found = clean.silver_clubs(spark.createDataFrame(rows, schema))
    assert found.columns == ["clube_id", "nome", "abreviacao", "escudo_url"]
    assert {r.clube_id: r.nome.strip() for r in found.collect()} == {51: "Norte", 52: "Sul do Vale"}
    assert found.count() == 2


def test_player_scores(spark):
    scores = spark.createDataFrame([(1, 7, 61, 2.5), (1, 7, 61, 4.0), (1, 8, 62, 1.0), (2, 7, 61, None)], "rodada int, atleta_id bigint, clube_id bigint, pontos double")
    status = spark.createDataFrame([(7, 3, 1), (7, 3, 2)], "atleta_id bigint, posicao_id int, status_id int")
    plain = clean.silver_player_scores(scores, status).collect()
    assert len(plain) == 5 and {r.posicao_id for r in plain if r.atleta_id == 8} == {None}
    single = {(r.rodada, r.atleta_id): (r.posicao_id, r.pontos) for r in clean.silver_player_scores(scores, status, dedupe=True).collect()}
    assert single == {(1, 7): (3, 4.0), (1, 8): (0, 1.0), (2, 7): (3, None)}


def test_points_and_flags(spark, season):
    rows = season.select("resultado", scoring.points("resultado", "casa").alias("h"), scoring.points("resultado", "visitante").alias("a")).distinct()
    assert {tuple(r) for r in rows.collect()} == {("casa", 3, 0), ("empate", 1, 1), ("visitante", 0, 3)}


def test_zones(spark):
    rows = spark.range(1, 23).selectExpr("cast(id as int) posicao").select("posicao", labels.zone().alias("z"), labels.zone_color().alias("c")).collect()
    zones = {r.posicao: (r.z, r.c) for r in rows}
    assert zones[4] == ("Libertadores (fase de grupos)", "#1a7a1a") and zones[6][0] == "Libertadores (pre-fase)"
    assert zones[12][1] == "#4682b4" and zones[13] == zones[16] == zones[21] == ("Meio de tabela", "#666666")
    assert zones[17] == zones[20] == ("Rebaixamento", "#cc2222")


def test_bands_and_names(spark):
    df = spark.createDataFrame([(70.0, None, "Time", 1), (69.9, "Nome", "Time", 2), (50.0, None, None, 3), (None, None, None, 4)], "p double, s string, n string, i bigint")
    rows = df.select(labels.confidence_band("p").alias("b"), labels.display_name("s", "n", "i").alias("n")).collect()
    assert [tuple(r) for r in rows] == [("alta", "Time"), ("media", "Nome"), ("media", "Clube 3"), ("baixa", "Clube 4")]


def test_unknown_club_shows_its_id_in_the_risk_table(spark, season):
    from matchweave.operators import features

    none = spark.createDataFrame([], "clube_id bigint, nome string")
    assert {r.nome_clube for r in standings.relegation_risk(features.feature_store(season), none).collect()} >= {"101"}
