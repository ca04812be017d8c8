"""Joins of facts, features and dimensions.

No join carries a broadcast hint: club tables grow with the league. Catalyst and AQE
broadcast a side only after checking its size, and split a skewed club or competition
otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from matchweave.operators.clubrows import START, by_club
from matchweave.operators.elo import START_RATING
from matchweave.operators.latest import KEY

SIDES = ("casa", "vis")


def club_id(side: str) -> str:
    return f"clube_{side}_id"


def join_features(enhanced: DataFrame, base: DataFrame, key: Sequence[str] = KEY, columns: Sequence[str] = ("saldo_gols",)) -> DataFrame:
    """Enhanced features with base columns of the same (round, club)."""
    on = [*key, "rodada", "clube_id"]
    return enhanced.join(base.select(*on, *columns), on)


# Model feature -> source column, for the home and the away club.
SHARED = {
    "elo": "elo_rating",
    "media_pontos_5j": "media_pontos_5j",
    "media_gols_marc_5j": "media_gols_marc_5j",
    "media_gols_sofr_5j": "media_gols_sofr_5j",
    "momentum": "momentum",
    "saldo_gols": "saldo_gols",
}
VENUE = {"casa": "aproveitamento_casa", "vis": "aproveitamento_fora"}


def side_features(side: str) -> dict[str, str]:
    own = {f"{name}_{side}": column for name, column in SHARED.items()}
    return own | {f"{VENUE[side]}_{side}": VENUE[side]}


FEATURES = [*side_features("casa"), *side_features("vis")]
STATE = sorted(set(SHARED.values()) | set(VENUE.values()))


def join_match_features(matches: DataFrame, state: DataFrame, key: Sequence[str] = KEY, on: Sequence[str] = ("rodada",)) -> DataFrame:
    """Matches with the 14 features of both clubs in the same round; null where absent.

    ``on`` names what a state belongs to besides its club: a round, a match, or nothing.
    """
    joined = matches
    for side in SIDES:
        columns = [F.col(column).alias(name) for name, column in side_features(side).items()]
        features = state.select(*key, *on, F.col("clube_id").alias(club_id(side)), *columns)
        joined = joined.join(features, [*key, *on, club_id(side)], "left")
    return joined.select(*matches.columns, *FEATURES)


def join_club_names(matches: DataFrame, clubs: DataFrame, columns: Sequence[str] = ("nome",)) -> DataFrame:
    """The club table in both roles: ``nome_casa``, ``nome_vis`` and so on."""
    joined = matches
    for side in SIDES:
        role = clubs.select(F.col("clube_id").alias(club_id(side)), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        joined = joined.join(role, club_id(side), "left")
    return joined.select(*matches.columns, *[f"{c}_{side}" for side in SIDES for c in columns])


def join_prediction_result(predictions: DataFrame, matches: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Predictions of matches that have been played since, with the actual result."""
    on = [*key, "rodada", club_id("casa"), club_id("vis")]
    known = matches.filter("resultado IS NOT NULL").select(*on, F.col("resultado").alias("resultado_real"))
    return predictions.join(known, on)


def last_round(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return df.groupBy(*key).agg(F.max("rodada").alias("rodada"))


def join_latest_round(store: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Rows of each competition's last round; clubs that sat it out are absent."""
    return store.join(last_round(store, key), [*key, "rodada"]).select(*store.columns)


def features_exact(fixtures: DataFrame, state: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Features of the fixture's own round; 0 where there is none."""
    return join_match_features(fixtures, state, key).fillna(0.0, subset=FEATURES)


def features_ahead(fixtures: DataFrame, state: DataFrame, key: Sequence[str] = KEY, start: float = START_RATING) -> DataFrame:
    """Features of upcoming fixtures from each club's state after its last match; a new club has the start rating and no history."""
    blank = {name: start if name.startswith("elo_") else 0.0 for name in FEATURES}
    return join_match_features(fixtures, state, key, on=()).fillna(blank)


def features_asof(fixtures: DataFrame, state: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Features of each club's latest round strictly before the fixture; 0 without one.

    Equi-joins only. The (round, club) pairs the fixtures ask for are put in one order
    with the club's states and take the last state seen; a pair sorts ahead of the state
    of its own round. Both have one row per club and round, so a club's group is bounded
    by the calendar. The answers then join like states of the fixture's own round.
    """
    on = [*key, "rodada", "clube_id"]
    clubs = F.explode(F.array(*map(club_id, SIDES))).alias("clube_id")
    asked = fixtures.select(*key, "rodada", clubs).distinct().withColumn("_tag", F.lit(0))
    states = state.select(*on, F.lit(1).alias("_tag"), F.struct(*STATE).alias("_state"))
    both = asked.unionByName(states, allowMissingColumns=True)
    seen = F.last("_state", ignorenulls=True).over(by_club(key, ("rodada", "_tag")).rowsBetween(START, 0))
    found = both.withColumn("_state", seen).filter("_tag = 0").select(*on, "_state.*")
    return features_exact(fixtures, found, key)


def match_features(fixtures: DataFrame, state: DataFrame, key: Sequence[str] = KEY, mode: str = "asof") -> DataFrame:
    return {"asof": features_asof, "exact": features_exact}[mode](fixtures, state, key)


def join_latest_six(
    predictions: DataFrame,
    clubs: DataFrame,
    standings: DataFrame,
    ratings: DataFrame,
    key: Sequence[str] = KEY,
) -> DataFrame:
    """Predictions left joined with clubs, latest standings and latest rating, per side.

    ``standings`` and ``ratings`` hold one row per (key, club). They share that key, so
    they are joined to each other first: a side then costs one join on it, not two.
    """
    names = clubs.withColumnRenamed("nome", "clube_nome")
    joined = join_club_names(predictions, names, ("clube_nome", "abreviacao", "escudo_url"))
    measures = ("pontos_acumulados", "aproveitamento_pct", "elo_rating")
    latest = standings.select(*key, "clube_id", *measures[:2]).join(
        ratings.select(*key, "clube_id", measures[2]), [*key, "clube_id"], "full"
    )
    out = joined
    for side in SIDES:
        role = latest.select(
            *key, F.col("clube_id").alias(club_id(side)), *[F.col(c).alias(f"{c}_{side}") for c in measures]
        )
        out = out.join(role, [*key, club_id(side)], "left")
    return out.select(*joined.columns, *[f"{c}_{s}" for s in SIDES for c in measures])


def join_standings(table: DataFrame, clubs: DataFrame, risk: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Standings left joined with club names and relegation risk."""
    named = table.join(clubs.select("clube_id", "nome", "abreviacao", "escudo_url"), "clube_id", "left")
    risk_columns = risk.select(*key, "clube_id", "prob_rebaixamento", "zona_rebaixamento")
    return named.join(risk_columns, [*key, "clube_id"], "left")


def join_venue_rates(form: DataFrame, home: DataFrame, away: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Form left joined with home rates and away rates of the same (club, round)."""
    on = [*key, "clube_id", "rodada"]
    with_home = form.join(home.select(*on, "aproveitamento_casa"), on, "left")
    return with_home.join(away.select(*on, "aproveitamento_fora"), on, "left")


def join_relegation_name(table: DataFrame, clubs: DataFrame, how: str = "left") -> DataFrame:
    return table.join(clubs.select("clube_id", F.col("nome").alias("nome_clube")), "clube_id", how)
