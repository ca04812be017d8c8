"""Column types of the published tables. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T


_KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(spec: str) -> T.StructType:
    """``name kind`` pairs to a schema; unlike a DDL parser it needs no session."""
    pairs = (column.split() for column in spec.split(","))
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


RAW_MATCHES = _schema("""
    competicao string, partida_id bigint, rodada int, clube_casa_id bigint, clube_vis_id bigint,
    placar_casa int, placar_vis int, data_partida timestamp_ntz, status string, raw_payload string""")

RAW_CLUBS = _schema("""
    clube_id bigint, nome string, abreviacao string, escudo_url string, raw_payload string""")

RAW_ATHLETES = _schema("""
    atleta_id bigint, nome string, clube_id bigint, posicao_id int, status_id int, raw_payload string""")

RAW_SCORES = _schema("""
    rodada int, atleta_id bigint, clube_id bigint, pontos double, raw_payload string""")

MATCHES = _schema("""
    competicao string, partida_id bigint, rodada int, clube_casa_id bigint, clube_vis_id bigint,
    placar_casa int, placar_vis int, data_partida timestamp_ntz, resultado string""")

REGISTRY = _schema("""
    modelo_nome string, versao string, algoritmo string, acuracia double, f1_score double,
    log_loss double, rodada_treino int, rodada_teste int, parametros string, ativo boolean,
    processed_at timestamp_ntz""")

RUNS = _schema("""
    run_id string, pipeline_name string, stage string, status string, started_at timestamp_ntz,
    finished_at timestamp_ntz, duration_seconds bigint, records_processed bigint, error_message string""")

CHECKS = _schema("""
    check_name string, tabela string, status string, records_checked bigint, records_failed bigint,
    detalhe string""")
