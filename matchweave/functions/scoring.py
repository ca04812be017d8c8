"""Row expressions on one match: result, points, outcome, hit."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HOME, DRAW, AWAY = "casa", "empate", "visitante"


def match_result(home: str, away: str) -> Column:
    """casa / visitante / empate; null while either score is missing."""
    h, a = F.col(home), F.col(away)
    return F.when(h == a, DRAW).when(h > a, HOME).when(h < a, AWAY)


def is_played(result: str = "resultado") -> Column:
    return F.col(result).isNotNull()


def outcome(result: str, venue: str) -> Column:
    """The match seen by the club at ``venue``: V(ictory), E(ven), D(efeat)."""
    r = F.col(result)
    return F.when(r == venue, "V").when(r == DRAW, "E").when(r.isNotNull(), "D")


def points(result: str, venue: str) -> Column:
    o = outcome(result, venue)
    return F.when(o == "V", 3).when(o == "E", 1).otherwise(0)


def outcome_flags(result: str, venue: str) -> dict[str, Column]:
    o = outcome(result, venue)
    return {
        name: F.coalesce((o == code).cast("int"), F.lit(0))
        for name, code in (("vitoria", "V"), ("empate", "E"), ("derrota", "D"))
    }


def hit(predicted: str = "previsao", actual: str = "resultado_real") -> Column:
    """True only when both are known and equal."""
    return F.coalesce(F.col(predicted) == F.col(actual), F.lit(False))
