"""Feature stores: the four published variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from matchweave.functions.numeric import half_up
from matchweave.operators import clubrows as C
from matchweave.operators.elo import POST, PRE, START_RATING, additive_delta, additive_total, elo, elo_simplified
from matchweave.operators.grid import cells, intervals
from matchweave.operators.latest import KEY, latest_per_key

STORE = [name for name, _ in C.CUMULATIVE] + ["saldo_gols", "aproveitamento_pct"]
ENHANCED = [
    "elo_rating", "media_pontos_5j", "media_gols_marc_5j", "media_gols_sofr_5j",
    "aproveitamento_casa", "aproveitamento_fora", "momentum",
]


ROW = ("rodada", "clube_id")


def _newest(rows: DataFrame, keys: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The row of the last match by date per key; an undated match counts as the last."""
    undated = rows.withColumn("_sem_data", F.col("data_partida").isNull())
    return latest_per_key(undated, keys, ["_sem_data", "data_partida", "partida_id"]).select(*keys, *keep)


def _store(rows: DataFrame, values: dict[str, Column], key: Sequence[str], per_round: bool, order: Sequence[str] = C.MATCH_ORDER) -> DataFrame:
    """One row per match of a club, or with ``per_round`` one per round: its last match there."""
    dates = ["data_partida", "partida_id"] if per_round else []
    out = C.over_clubs(rows, values, [*key, *ROW, *dates], key, order)
    return _newest(out, [*key, *ROW], list(values)) if per_round else out


def feature_store(
    matches: DataFrame, key: Sequence[str] = KEY, variant: str = "sql", per_round: bool = False
) -> DataFrame:
    """State of each club after each of its matches.

    ``sql`` rounds the rate to 2 digits; ``job`` leaves it unrounded and carries the
    doubly accumulated goal difference the model trains on.
    """
    if variant == "job":
        goals, rate = C.goal_diff_double(key)["saldo_gols_double"], C.success_rate(key)
        values = C.cum_stats(key) | {"saldo_gols": goals} | rate
    else:
        values = C.cum_stats(key) | C.goal_diff(key) | C.success_rate(key, digits=2)
    return _store(C.club_rows(matches, key), values, key, per_round)


def _known(key: Sequence[str], last: int) -> dict[str, Column]:
    """Form by date up to the match before (``last`` = -1) or with this one (0)."""
    form = C.form5_prior(key, last=last) | C.venue_rate_prior(key, last=last) | C.momentum_sum3(key, last=last)
    return {n: c.cast("double") for n, c in form.items()}


def features_job(matches: DataFrame, key: Sequence[str] = KEY, per_round: bool = False, rated: bool = False, **elo_options) -> DataFrame:
    """Sequential Elo and form before each match, both by date. ``rated`` matches have their ratings already."""
    rows = C.club_rows(matches if rated else elo(matches, key, **elo_options), key, carry={"elo_rating": PRE})
    values = {"elo_rating": F.col("elo_rating")} | _known(key, -1)
    return _store(rows, {n: values[n] for n in ENHANCED}, key, per_round, C.DATE_ORDER)


def model_state(matches: DataFrame, key: Sequence[str] = KEY, ahead: bool = False, rated: bool = False, **elo_options) -> DataFrame:
    """What is known of a club by date: before each of its matches, or with ``ahead`` after its last, for the next one.

    The same quantities both times, so that a model meets at prediction what it was trained on. Keyed by
    (partida_id, club), or with ``ahead`` by club. ``rated`` matches have the ratings before and after each already.
    """
    rows = C.club_rows(matches if rated else elo(matches, key, after=ahead, **elo_options), key, carry={"elo_rating": POST if ahead else PRE})
    last = 0 if ahead else -1
    goals = C.goal_diff_double(key, C.DATE_ORDER, last)["saldo_gols_double"]
    values = {"elo_rating": F.col("elo_rating")} | _known(key, last) | {"saldo_gols": goals}
    out = C.over_clubs(rows, values, [*key, "partida_id", "clube_id", "data_partida"], key, C.DATE_ORDER)
    return _newest(out, [*key, "clube_id"], list(values)) if ahead else out.drop("data_partida")


def features_sql(
    matches: DataFrame, key: Sequence[str] = KEY, per_round: bool = False
) -> DataFrame:
    """Simplified rating and form with the match included; venue rates in the same pass."""
    values = C.form_incl(key) | C.venue_rate_incl(key, default=None)
    return combine_sql(_store(C.club_rows(matches, key), values, key, per_round), key)


def combine_sql(raw: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Published columns from form means and venue rates that may be null."""
    rates = ["aproveitamento_casa", "aproveitamento_fora"]
    rating = elo_simplified(F.col(rates[0]), F.col(rates[1]), F.col("media_pontos_5j"))
    zero = F.lit(0.0)
    momentum = F.coalesce("media_pontos_3j", zero) - F.coalesce("media_pontos_6j", zero)
    means = ["media_pontos_5j", "media_gols_marc_5j", "media_gols_sofr_5j"]
    return raw.select(
        *key, "rodada", "clube_id", rating.alias("elo_rating"),
        *[F.coalesce(c, zero).alias(c) for c in means + rates],
        momentum.alias("momentum"),
    )


def seed_intervals(matches: DataFrame, base: DataFrame, key: Sequence[str] = KEY, k: float = 30) -> DataFrame:
    """Additive rating and venue points as intervals of rounds: the table to publish, since its size follows the matches."""
    form = {n: half_up(c, 4) for n, c in C.form_incl(key, points_over=()).items()}
    moved = {"_moved": additive_total(key)}
    values = form | C.venue_points_pct(key) | C.momentum_weighted(key) | moved
    rows = C.club_rows(matches, key).withColumn("_delta", additive_delta(k))
    states = _store(rows, values, key, True)
    before = {n: 0.0 for n in values} | {"momentum": 0.5}
    spans = intervals(states, before, key).join(base.select("clube_id", "elo_base"), "clube_id", "left")
    rating = half_up(F.coalesce("elo_base", F.lit(START_RATING)) + F.col("_moved"), 2)
    return spans.withColumn("elo_rating", rating).select(*key, "clube_id", "de", "ate", *ENHANCED)


def features_seed(
    matches: DataFrame, base: DataFrame, key: Sequence[str] = KEY, k: float = 30, rounds: DataFrame | None = None
) -> DataFrame:
    """Additive rating and venue points on the grid of all clubs and rounds, or of the ``rounds`` (key, rodada) asked for."""
    return cells(seed_intervals(matches, base, key, k), rounds, key).select(*key, *ROW, *ENHANCED)


def grid_intervals(matches: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Cumulative statistics of every club as intervals of rounds."""
    values = C.cum_stats(key) | C.games(key)
    return intervals(_store(C.club_rows(matches, key), values, key, True), dict.fromkeys(values, 0), key)


def round_club_grid(matches: DataFrame, key: Sequence[str] = KEY, rounds: DataFrame | None = None) -> DataFrame:
    """Cumulative statistics of every club in every round, or in the ``rounds`` (key, rodada) asked for."""
    grid = cells(grid_intervals(matches, key), rounds, key)
    return grid.select(
        *key, *ROW, *[n for n, _ in C.CUMULATIVE],
        (F.col("gols_marcados") - F.col("gols_sofridos")).alias("saldo_gols"),
        C.points_rate_zero("pontos_acumulados", F.col("jogos")).alias("aproveitamento_pct"),
    )
