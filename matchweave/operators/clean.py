"""Raw feeds to clean tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from matchweave.functions.scoring import is_played, match_result
from matchweave.operators.latest import KEY, MATCH_KEY, latest_per_key


def played(matches: DataFrame) -> DataFrame:
    return matches.filter(is_played())


def upcoming(matches: DataFrame) -> DataFrame:
    return matches.filter(~is_played())


def with_result(raw: DataFrame) -> DataFrame:
    return raw.withColumn("resultado", match_result("placar_casa", "placar_vis"))


def clean_matches(raw: DataFrame) -> DataFrame:
    """Matches whose round and clubs are known, with their result."""
    return with_result(raw.dropna(subset=list(MATCH_KEY))).withColumn(
        "data_partida", F.col("data_partida").cast("timestamp_ntz")
    )


def silver_matches(
    raw: DataFrame,
    key: Sequence[str] = KEY,
    played_only: bool = False,
    order: Sequence[str] = ("data_partida", "partida_id"),
) -> DataFrame:
    """One row per (key, round, home, away), the latest feed entry by ``order`` winning.

    Upcoming matches stay unless ``played_only``, which drops them before the dedupe.
    """
    clean = clean_matches(raw)
    clean = played(clean) if played_only else clean
    columns = [*key, "partida_id", *MATCH_KEY, "placar_casa", "placar_vis", "data_partida", "resultado"]
    extra = [c for c in order if c not in columns]
    return latest_per_key(clean.select(*columns, *extra), [*key, *MATCH_KEY], order).select(*columns)


def one_match_per_round(matches: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Keep a match only if it is the first of its round for both clubs.

    This establishes the key (competition, round, club) of the feature tables. Every
    per-club window downstream relies on it: a club's group is never longer than the
    calendar, however many raw rows name the club. Two aggregations, reduced before their exchange, no window.
    """
    columns = matches.columns
    row = F.struct("data_partida", "partida_id", *[c for c in columns if c not in ("data_partida", "partida_id")])
    sides = matches.select(
        *key, "rodada", F.explode(F.array("clube_casa_id", "clube_vis_id")).alias("_clube"), row.alias("_m")
    )
    first = sides.groupBy(*key, "rodada", "_clube").agg(F.min("_m").alias("_m")).select("_m.*")
    return first.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n = 2").select(*columns)


def clean_clubs(raw: DataFrame) -> DataFrame:
    return raw.dropna(subset=["clube_id", "nome"])


def silver_clubs(raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One trimmed row per club."""
    trimmed = clean_clubs(raw).select(
        "clube_id", F.trim("nome").alias("nome"), F.trim("abreviacao").alias("abreviacao"), "escudo_url", *order
    )
    return latest_per_key(trimmed, ["clube_id"], list(order)).select(
        "clube_id", "nome", "abreviacao", "escudo_url"
    )


def clean_scores(scores: DataFrame) -> DataFrame:
    return scores.dropna(subset=["pontos", "rodada"])


def join_score_position(scores: DataFrame, athletes: DataFrame, columns: Sequence[str] = ("posicao_id",)) -> DataFrame:
    """Scores with the athlete's columns; null where the athlete is unknown.

    No broadcast hint: the athlete table grows with the league, and AQE both checks its
    size and splits a skewed athlete.
    """
    return scores.join(athletes.select("atleta_id", *columns), "atleta_id", "left")


def silver_player_scores(scores: DataFrame, athletes: DataFrame, dedupe: bool = False) -> DataFrame:
    """Scores with position and status.

    ``dedupe`` gives the other published shape: no status, unknown position 0 and one
    row (the highest score) per (round, athlete).
    """
    if not dedupe:
        joined = join_score_position(clean_scores(scores), athletes, ["posicao_id", "status_id"])
        return joined.select("rodada", "atleta_id", "clube_id", "posicao_id", "status_id", "pontos")
    best = latest_per_key(
        scores.select("rodada", "atleta_id", "clube_id", "pontos"), ["rodada", "atleta_id"], ["pontos", "clube_id"]
    )
    one_each = latest_per_key(athletes.select("atleta_id", "posicao_id"), ["atleta_id"], ["posicao_id"])
    return join_score_position(best, one_each).select(
        "rodada", "atleta_id", "clube_id", F.coalesce("posicao_id", F.lit(0)).alias("posicao_id"), "pontos"
    )
