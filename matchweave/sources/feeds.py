"""Landed JSON feed documents to typed raw rows.

A feed is a DataFrame with a string column ``payload`` and any key columns, which are
carried over. Nothing here fails on bad input: a payload that is no JSON object, or lacks
the expected member, yields no row; ``rejects`` lists the former.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from matchweave.schemas import RAW_ATHLETES, RAW_CLUBS, RAW_MATCHES, RAW_SCORES

PAYLOAD = "payload"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def _number(name: str, kind: str = "int", default: object = 0) -> Column:
    value = F.col(f"_e.{name}").try_cast(kind)
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))


def _text(name: str) -> Column:
    return F.coalesce(F.col(f"_e.{name}"), F.lit(""))


def _elements(feed: DataFrame, member: str | None, as_map: bool, fields: str) -> DataFrame:
    """One row per array element or map entry: its JSON text whole, and ``fields`` as ``_e``.

    Typing the elements as strings makes the parser hand over their source text, so
    unknown members survive in ``raw_payload``. The fields are read as strings in one
    further parse and cast by the caller, since feeds quote numbers at will.
    """
    if ":" not in fields:
        fields = ", ".join(f"{name}: string" for name in fields.split())
    container = "map<string,string>" if as_map else "array<string>"
    keys = [c for c in feed.columns if c != PAYLOAD]
    if member:
        parsed = F.from_json(PAYLOAD, f"`{member}` {container}")[member]
    else:
        parsed = F.from_json(PAYLOAD, container)
    out = ("_id", "raw_payload") if as_map else ("raw_payload",)
    rows = feed.select(*keys, F.explode(parsed).alias(*out)).filter("raw_payload IS NOT NULL")
    return rows.withColumn("_e", F.from_json("raw_payload", f"struct<{fields}>"))


def _select(rows: DataFrame, schema, columns: dict[str, Column], keys: list[str]) -> DataFrame:
    return rows.select(
        *[k for k in keys if k not in columns],
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in schema if f.name in columns],
    )


def _keys(feed: DataFrame) -> list[str]:
    return [c for c in feed.columns if c != PAYLOAD]


def ingest_matches(feed: DataFrame) -> DataFrame:
    """Matches of ``{"partidas": [...]}``. Missing ids become 0, missing scores stay null.

    A feed without ``partida_id`` gets one derived from round and clubs, the same on every
    ingest of the match.
    """
    text = F.col("_e.partida_data")
    date = F.when(text.rlike(DATE_PATTERN), text.try_cast("timestamp_ntz"))
    fields = (
        "partida_id rodada clube_casa_id clube_visitante_id placar_oficial_mandante placar_oficial_visitante "
        "partida_data partida_status"
    )
    natural = {
        "rodada": _number("rodada"),
        "clube_casa_id": _number("clube_casa_id", "bigint"),
        "clube_vis_id": _number("clube_visitante_id", "bigint"),
    }
    columns = natural | {
        "partida_id": F.coalesce(_number("partida_id", "bigint", None), F.xxhash64(*natural.values())),
        "placar_casa": _number("placar_oficial_mandante", default=None),
        "placar_vis": _number("placar_oficial_visitante", default=None),
        "data_partida": date,
        "status": _text("partida_status"),
        "raw_payload": F.col("raw_payload"),
    }
    return _select(_elements(feed, "partidas", False, fields), RAW_MATCHES, columns, _keys(feed))


def ingest_clubs(feed: DataFrame) -> DataFrame:
    """Clubs of a map keyed by club id; the crest sits in a nested object."""
    columns = {
        "clube_id": F.col("_id"),
        "nome": _text("nome"),
        "abreviacao": _text("abreviacao"),
        "escudo_url": _text("escudos.60x60"),
        "raw_payload": F.col("raw_payload"),
    }
    fields = "nome: string, abreviacao: string, escudos: struct<`60x60`: string>"
    rows = _elements(feed, None, True, fields).withColumn("_id", F.expr("try_cast(_id AS bigint)"))
    return _select(rows.filter("_id IS NOT NULL"), RAW_CLUBS, columns, _keys(feed))


def ingest_athletes(feed: DataFrame) -> DataFrame:
    columns = {
        "atleta_id": _number("atleta_id", "bigint"),
        "nome": _text("apelido"),
        "clube_id": _number("clube_id", "bigint"),
        "posicao_id": _number("posicao_id"),
        "status_id": _number("status_id"),
        "raw_payload": F.col("raw_payload"),
    }
    return _select(_elements(feed, "atletas", False, "atleta_id apelido clube_id posicao_id status_id"), RAW_ATHLETES, columns, _keys(feed))


def ingest_scores(feed: DataFrame, rodada: int | None = None) -> DataFrame:
    """Scores of ``{"atletas": {id: {...}}}``; the round is given, or a column of the feed."""
    columns = {
        "rodada": F.col("rodada") if rodada is None else F.lit(rodada),
        "atleta_id": F.col("_id"),
        "clube_id": _number("clube_id", "bigint"),
        "pontos": _number("pontuacao", "double", 0.0),
        "raw_payload": F.col("raw_payload"),
    }
    rows = _elements(feed, "atletas", True, "clube_id pontuacao").withColumn("_id", F.expr("try_cast(_id AS bigint)"))
    return _select(rows.filter("_id IS NOT NULL"), RAW_SCORES, columns, _keys(feed))


def is_object(payload: str = PAYLOAD) -> Column:
    """Whether the payload parses as a JSON object."""
    parsed = F.from_json(payload, "map<string,string>", {"mode": "PERMISSIVE"})
    return parsed.isNotNull()


def rejects(feed: DataFrame) -> DataFrame:
    """Payloads the ingests skip, for a warning or a quarantine table."""
    return feed.filter(~is_object())


def current_round(status: DataFrame, default: int = 1) -> DataFrame:
    """Round of ``{"rodada": {"rodada_atual": n}}`` per status document."""
    value = F.expr(f"try_cast(get_json_object({PAYLOAD}, '$.rodada.rodada_atual') AS int)")
    keys = [c for c in status.columns if c != PAYLOAD]
    return status.select(*keys, F.coalesce(value, F.lit(default)).alias("rodada_atual"))
