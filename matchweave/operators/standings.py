"""League tables and relegation risk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from matchweave.functions.labels import zone, zone_color
from matchweave.functions.numeric import half_up, pct
from matchweave.operators.joins import join_latest_round, join_relegation_name, join_standings
from matchweave.operators.latest import KEY, latest_per_key, rank_within


def latest_state(store: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Each club's row of its own last round."""
    return latest_per_key(store, [*key, "clube_id"], ["rodada"])


def standings_rank(table: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    order = ["pontos_acumulados", "vitorias", "saldo_gols", "gols_marcados"]
    return rank_within(table, key, order, "clube_id", "posicao")


def points_rank(table: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return rank_within(table, key, ["pontos_acumulados", "aproveitamento_pct"], "clube_id", "ranking")


def relegation_rank(table: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return rank_within(table, key, ["pontos_acumulados", "vitorias", "saldo_gols"], "clube_id", "posicao")


def with_games(table: DataFrame) -> DataFrame:
    return table.withColumn("jogos", F.col("vitorias") + F.col("empates") + F.col("derrotas"))


def view_standings(store: DataFrame, clubs: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Table of the last round; clubs without a match in it or without a name are dropped."""
    current = join_latest_round(store, key).join(clubs.select("clube_id", "nome", "abreviacao"), "clube_id")
    return standings_rank(with_games(current), key).select(
        *key, "posicao", "clube_id", "nome", "abreviacao", "jogos",
        F.col("pontos_acumulados").alias("pontos"), "vitorias", "empates", "derrotas",
        F.col("gols_marcados").alias("gols_pro"), F.col("gols_sofridos").alias("gols_contra"), "saldo_gols",
        F.col("aproveitamento_pct").alias("aproveitamento"),
    )


def view_ranking(store: DataFrame, clubs: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """The published "Elo" ranking, which orders by points and rate."""
    current = join_latest_round(store, key).join(clubs.select("clube_id", "nome", "abreviacao"), "clube_id")
    return points_rank(current, key).select(
        *key, "ranking", "clube_id", "nome", "abreviacao", F.col("pontos_acumulados").alias("pontos"),
        F.col("aproveitamento_pct").alias("aproveitamento"), "vitorias", "empates", "derrotas",
    )


# Fixed values of the logistic risk: steepness, midpoint, clubs relegated.
STEEPNESS, MIDPOINT, RELEGATED = 10, 0.85, 4

RISK_COLUMNS = [
    "clube_id", "nome_clube", "posicao", "pontos", "jogos", "saldo_gols", "prob_rebaixamento", "zona_rebaixamento",
]


def relegation_risk(store: DataFrame, clubs: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Logistic risk by relative place in the last round's table."""
    current = with_games(join_latest_round(store, key))
    ranked = relegation_rank(current, key)
    total = current.groupBy(*key).agg(F.count("*").alias("_n"))
    place = F.col("posicao") / F.col("_n")
    risk = 1 / (1 + F.exp((place - MIDPOINT) * -STEEPNESS))
    named = join_relegation_name(ranked.join(total, list(key)), clubs)
    return named.withColumns(
        {
            "nome_clube": F.coalesce("nome_clube", F.col("clube_id").cast("string")),
            "pontos": F.col("pontos_acumulados"),
            "prob_rebaixamento": half_up(risk, 4),
            "zona_rebaixamento": F.col("posicao") > F.col("_n") - RELEGATED,
        }
    ).select(*key, *RISK_COLUMNS)


# Fixed values of the stepwise risk: last place of the step, risk at its base, base place, rise per place.
RISK_STEPS = [
    (4, "0.01", 1, "0.01"),
    (8, "0.02", 4, "0.02"),
    (12, "0.08", 8, "0.04"),
    (16, "0.22", 12, "0.08"),
    (None, "0.55", 16, "0.10"),
]
RISK_CAP, ZONE_START = "0.95", 17


def relegation_piecewise(ranked: DataFrame) -> DataFrame:
    """Stepwise risk by absolute place, in exact decimals."""
    place = F.col("posicao")

    def dec(value: str):
        return F.lit(value).cast("decimal(6,4)")

    steps = []
    for last, base, origin, rise in RISK_STEPS:
        value = dec(base) + (place - origin).cast("decimal(10,0)") * dec(rise)
        steps.append(value if last is None else F.when(place <= last, value))
    risk = F.least(F.coalesce(*steps), dec(RISK_CAP)).cast("double")
    return ranked.withColumns({"prob_rebaixamento": risk, "zona_rebaixamento": place >= ZONE_START})


def mart_standings(store: DataFrame, clubs: DataFrame, risk: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Published table: every club at its latest state, with zone and risk."""
    table = standings_rank(with_games(latest_state(store, key)), key)
    return join_standings(table, clubs, risk, key).select(
        *key, "posicao", F.col("nome").alias("clube"), "abreviacao", "escudo_url", "jogos",
        F.col("pontos_acumulados").alias("pontos"),
        F.col("vitorias").alias("v"), F.col("empates").alias("e"), F.col("derrotas").alias("d"),
        F.col("gols_marcados").alias("gm"), F.col("gols_sofridos").alias("gs"), F.col("saldo_gols").alias("sg"),
        F.col("aproveitamento_pct").alias("aproveitamento"),
        pct(F.col("prob_rebaixamento")).alias("prob_rebaixamento_pct"), "zona_rebaixamento",
        zone().alias("situacao"), zone_color().alias("cor_situacao"),
    )
