"""Match facts to one row per club, and the running statistics on them.

Statistics are window columns over one partitioning and one order, so a feature table
costs one exchange and one sort. ``over_clubs`` evaluates them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from matchweave.functions.numeric import half_up
from matchweave.functions.scoring import AWAY, HOME, outcome_flags, points
from matchweave.operators.clean import played
from matchweave.operators.latest import KEY

MATCH_ORDER = ("rodada", "data_partida", "partida_id")
#: What a club knew before a match follows the dates, not the rounds: a postponed match comes late.
DATE_ORDER = ("data_partida", "partida_id")
START = Window.unboundedPreceding


def club_rows(matches: DataFrame, key: Sequence[str] = KEY, carry: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Each played match as two rows, read once.

    ``carry`` maps a new column to its (home column, away column).
    """
    def side(venue: str) -> Column:
        home = venue == HOME
        mine, theirs = ("casa", "vis") if home else ("vis", "casa")
        flags = outcome_flags("resultado", venue)
        extra = [F.col(pair[0 if home else 1]).alias(name) for name, pair in (carry or {}).items()]
        return F.struct(
            F.col(f"clube_{mine}_id").alias("clube_id"),
            F.lit(home).alias("eh_casa"),
            points("resultado", venue).alias("pontos"),
            *[flag.alias(name) for name, flag in flags.items()],
            F.coalesce(f"placar_{mine}", F.lit(0)).alias("gols_marcados"),
            F.coalesce(f"placar_{theirs}", F.lit(0)).alias("gols_sofridos"),
            *extra,
        )

    return played(matches).select(*key, *MATCH_ORDER, F.inline(F.array(side(HOME), side(AWAY))))


def by_club(key: Sequence[str] = KEY, order: Sequence[str] = MATCH_ORDER) -> WindowSpec:
    """A club's rows in order, what has no date or round yet at the end."""
    return Window.partitionBy(*key, "clube_id").orderBy(*[F.asc_nulls_last(c) for c in order])


def over_clubs(
    rows: DataFrame, values: dict[str, Column], keep: Sequence[str], key: Sequence[str] = KEY, order: Sequence[str] = MATCH_ORDER
) -> DataFrame:
    """``keep`` and the window ``values`` of every club row, in one exchange and one sort.

    A club's group is as long as its calendar, whatever the number of clubs and competitions. ``order`` is
    that of the values and of the row number that weighted sums use.
    """
    rows = rows.withColumn("_jogos", F.lit(1))
    numbered = rows.withColumn("_n", F.sum("_jogos").over(by_club(key, order).rowsBetween(START, 0)))
    weighted = numbered.withColumns({name: F.col("_n") * F.col(column) for name, column in WEIGHTED.items()})
    return weighted.select(*keep, *[c.alias(n) for n, c in values.items()])


WEIGHTED = {"_n_marcados": "gols_marcados", "_n_sofridos": "gols_sofridos"}


def _running(column: str, key: Sequence[str], first: int = START, last: int = 0, order: Sequence[str] = MATCH_ORDER) -> Column:
    return F.sum(column).over(by_club(key, order).rowsBetween(first, last))


# (published name, column summed) of the cumulative statistics
CUMULATIVE = [
    ("pontos_acumulados", "pontos"),
    ("vitorias", "vitoria"),
    ("empates", "empate"),
    ("derrotas", "derrota"),
    ("gols_marcados", "gols_marcados"),
    ("gols_sofridos", "gols_sofridos"),
]


def cum_stats(key: Sequence[str] = KEY) -> dict[str, Column]:
    return {name: _running(column, key) for name, column in CUMULATIVE}


def goal_diff(key: Sequence[str] = KEY) -> dict[str, Column]:
    return {"saldo_gols": _running("gols_marcados", key) - _running("gols_sofridos", key)}


def goal_diff_double(key: Sequence[str] = KEY, order: Sequence[str] = MATCH_ORDER, last: int = 0) -> dict[str, Column]:
    """Goal difference of running totals, summed once more: what the model trains on.

    The sum of n running totals is (n + 1) times the last one less the sum of each value
    times its number, so it needs no second pass. ``last`` = -1 leaves this match out.
    """
    def doubled(goals: str, weighted: str) -> Column:
        count = F.col("_n") + 1 + last
        return count * _running(goals, key, START, last, order) - _running(weighted, key, START, last, order)

    scored, conceded = (doubled(goals, name) for name, goals in WEIGHTED.items())
    return {"saldo_gols_double": F.coalesce(scored - conceded, F.lit(0))}


def games(key: Sequence[str] = KEY) -> dict[str, Column]:
    return {"jogos": _running("_jogos", key)}


def success_rate(key: Sequence[str] = KEY, digits: int | None = None) -> dict[str, Column]:
    """Points won of the points possible, in percent."""
    rate = _running("pontos", key) / (games(key)["jogos"] * 3) * 100
    return {"aproveitamento_pct": rate if digits is None else half_up(rate, digits)}


def form5_prior(key: Sequence[str] = KEY, n: int = 5, last: int = -1) -> dict[str, Column]:
    """Means over the ``n`` matches before this one by date; 0 without history. ``last`` = 0 ends with this one."""
    window = by_club(key, DATE_ORDER).rowsBetween(last + 1 - n, last)
    return {
        name: F.coalesce(F.avg(column).over(window), F.lit(0.0))
        for name, column in _form_columns(n)
    }


def _form_columns(n: int) -> list[tuple[str, str]]:
    return [
        (f"media_pontos_{n}j", "pontos"),
        (f"media_gols_marc_{n}j", "gols_marcados"),
        (f"media_gols_sofr_{n}j", "gols_sofridos"),
    ]


def form_incl(key: Sequence[str] = KEY, n: int = 5, points_over: Sequence[int] = (3, 6)) -> dict[str, Column]:
    """Means over the last ``n`` matches with this one, and of the points over other sizes."""
    def mean(column: str, size: int) -> Column:
        return F.avg(column).over(by_club(key).rowsBetween(1 - size, 0))

    form = {name: mean(column, n) for name, column in _form_columns(n)}
    return form | {f"media_pontos_{size}j": mean("pontos", size) for size in points_over}


def _venue_sum(column: str, home: bool, key: Sequence[str], last: int, order: Sequence[str] = MATCH_ORDER) -> Column:
    at_venue = F.when(F.col("eh_casa") == home, F.col(column)).otherwise(0)
    return F.sum(at_venue).over(by_club(key, order).rowsBetween(START, last))


def venue_rate_prior(key: Sequence[str] = KEY, last: int = -1) -> dict[str, Column]:
    """Home (away) wins over home (away) games of all matches before this one by date; 0 for none."""
    def rate(home: bool) -> Column:
        won = _venue_sum("vitoria", home, key, last, DATE_ORDER)
        played_there = _venue_sum("_jogos", home, key, last, DATE_ORDER)
        return F.coalesce(won / F.greatest(played_there, F.lit(1)), F.lit(0.0))

    return {"aproveitamento_casa": rate(True), "aproveitamento_fora": rate(False)}


def venue_rate_incl(key: Sequence[str] = KEY, default: float | None = 0.0) -> dict[str, Column]:
    """Win rate at this row's venue with this match; ``default`` in the other column."""
    def rate(home: bool) -> Column:
        value = _venue_sum("vitoria", home, key, 0) / F.nullif(_venue_sum("_jogos", home, key, 0), F.lit(0))
        here = F.when(F.col("eh_casa") == home, value)
        return here if default is None else F.coalesce(here, F.lit(default))

    return {"aproveitamento_casa": rate(True), "aproveitamento_fora": rate(False)}


def venue_points_pct(key: Sequence[str] = KEY) -> dict[str, Column]:
    """Points won at home (away) of those possible there, in percent; on every row."""
    def rate(home: bool) -> Column:
        possible = _venue_sum("_jogos", home, key, 0) * 3
        won = _venue_sum("pontos", home, key, 0)
        return F.coalesce(half_up(won / F.nullif(possible, F.lit(0)) * 100, 2), F.lit(0.0))

    return {"aproveitamento_casa": rate(True), "aproveitamento_fora": rate(False)}


def momentum_sum3(key: Sequence[str] = KEY, n: int = 3, last: int = -1) -> dict[str, Column]:
    """Points of the ``n`` matches before this one by date."""
    return {"momentum": F.coalesce(_running("pontos", key, last + 1 - n, last, DATE_ORDER), F.lit(0))}


def momentum_diff(key: Sequence[str] = KEY) -> dict[str, Column]:
    """Mean points over 3 matches less that over 6, this one included."""
    form = form_incl(key)
    return {"momentum": form["media_pontos_3j"] - form["media_pontos_6j"]}


def momentum_weighted(key: Sequence[str] = KEY) -> dict[str, Column]:
    """Weighted outcome of the newest 3 matches, weights 3, 2, 1 from the newest."""
    value = F.when(F.col("vitoria") == 1, 1.0).when(F.col("empate") == 1, 0.5).otherwise(0.0)
    terms = [(3, value)] + [(3 - back, F.lag(value, back).over(by_club(key))) for back in (1, 2)]
    won = sum((F.coalesce(v * w, F.lit(0.0)) for w, v in terms), F.lit(0.0))
    weight = sum((F.when(v.isNotNull(), w).otherwise(0) for w, v in terms), F.lit(0))
    return {"momentum": half_up(won / weight, 4)}


def points_rate_zero(points_total: str, games_played: Column) -> Column:
    """Success rate with 2 digits, 0 before the first game."""
    rate = F.col(points_total) / F.nullif(games_played * 3, F.lit(0)) * 100
    return F.coalesce(half_up(rate, 2), F.lit(0.0))
