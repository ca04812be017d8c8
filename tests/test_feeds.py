"""JSON feeds: typed rows, defaults, tolerance."""

import json

from matchweave.sources import feeds
from tests import golden


def landed(spark, *documents, **keys):
    names = ", ".join(f"{k} string" for k in keys)
    return spark.createDataFrame([(*keys.values(), d) for d in documents], f"{names + ', ' if keys else ''}payload string")


def test_matches(spark):
    feed = landed(spark, golden.feed_document(golden.games(), lambda r: r[1] < 5), competicao="A")
    rows = feeds.ingest_matches(feed)
    assert rows.columns[0] == "competicao" and rows.count() == 50
    _, _, home, away, *goals, date = golden.games()[0]
    first = rows.filter(f"rodada = 1 AND clube_casa_id = {home}").first()
    assert [first.clube_vis_id, first.placar_casa, first.placar_vis] == [away, *goals]
    assert first.data_partida == date
    assert json.loads(first.raw_payload)["local"] == "São Paulo"
    assert rows.filter("placar_casa IS NULL").count() == 10
    assert rows.select("partida_id").distinct().count() == 50
    assert sorted(map(tuple, feeds.ingest_matches(feed).collect())) == sorted(map(tuple, rows.collect()))


def test_match_defaults(spark):
    document = json.dumps({"partidas": [{"placar_oficial_mandante": "2", "partida_data": ""}, {"rodada": "3", "partida_data": "ontem"}]})
    rows = {r.rodada: r for r in feeds.ingest_matches(landed(spark, document)).collect()}
    assert (rows[0].clube_casa_id, rows[0].clube_vis_id, rows[0].placar_casa, rows[0].placar_vis) == (0, 0, 2, None)
    assert rows[0].data_partida is None and rows[0].status == "" and rows[3].data_partida is None


def test_bad_payloads_give_no_rows(spark):
    bad = ["", "not json", "[1, 2]", "null", "{}", '{"partidas": []}', '{"partidas": null}', '{"partidas": 3}', None, '{"partidas": [']
    feed = landed(spark, *bad)
    for ingest in (feeds.ingest_matches, feeds.ingest_athletes, lambda f: feeds.ingest_scores(f, 1)):
        assert ingest(feed).count() == 0
    rejected = {r.payload for r in feeds.rejects(feed).collect()}
    assert rejected == {"", "not json", "[1, 2]", "null", None, '{"partidas": ['}


def test_clubs(spark):
    document = '{"41": {"nome": "Serra", "abreviacao": "SER", "escudos": {"60x60": "u"}}, "42": {}, "x": {"nome": "?"}}'
    rows = {r.clube_id: r for r in feeds.ingest_clubs(landed(spark, document)).collect()}
    assert set(rows) == {41, 42}
    assert (rows[41].nome, rows[41].abreviacao, rows[41].escudo_url) == ("Serra", "SER", "u")
    assert (rows[42].nome, rows[42].escudo_url, rows[42].raw_payload) == ("", "", "{}")


def test_athletes(spark):
    document = '{"atletas": [{"atleta_id": 7, "apelido": "Zé", "clube_id": 41, "posicao_id": 5, "status_id": 2}, {}]}'
    rows = {r.atleta_id: r for r in feeds.ingest_athletes(landed(spark, document)).collect()}
    assert (rows[7].nome, rows[7].clube_id, rows[7].posicao_id, rows[7].status_id) == ("Zé", 41, 5, 2)
    assert (rows[0].nome, rows[0].clube_id) == ("", 0)


def test_scores(spark):
    document = '{"atletas": {"7": {"clube_id": 41, "pontuacao": 4.5}, "8": {}}}'
    rows = {r.atleta_id: r for r in feeds.ingest_scores(landed(spark, document), 3).collect()}
    assert (rows[7].rodada, rows[7].clube_id, rows[7].pontos) == (3, 41, 4.5)
    assert (rows[8].clube_id, rows[8].pontos) == (0, 0.0)


def test_current_round(spark):
    documents = ['{"rodada": {"rodada_atual": 12}}', '{"rodada": {}}', "{}", "x"]
    assert sorted(r.rodada_atual for r in feeds.current_round(landed(spark, *documents)).collect()) == [1, 1, 1, 12]
