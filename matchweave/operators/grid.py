"""A row for every club in every round, state carried forward."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from matchweave.operators.clubrows import by_club
from matchweave.operators.latest import KEY


def intervals(states: DataFrame, values: dict[str, object], key: Sequence[str] = KEY) -> DataFrame:
    """(key, clube_id, de, ate, values): from which round to which a club is in a state, over rounds 1..last of the competition.

    ``states`` has one row per club and round, so a club's window is as long as the calendar. ``values`` maps each state column to its
    value before the club's first match. A state holds from its own round up to the round before the club's next match, so the table
    has one row for each state and one more for each club at most, whatever the number of rounds.
    """
    columns = list(values)
    by_round = by_club(key, ["rodada"])
    last_round = states.groupBy(*[F.col(c).alias(f"_k_{c}") for c in key]).agg(F.max("rodada").alias("_last"))
    spans = states.withColumns(
        {"_next": F.lead("rodada").over(by_round), "_first": F.row_number().over(by_round) == 1}
    ).join(last_round, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in key])

    def span(start: Column, end: Column, state: list[Column]) -> Column:
        return F.struct(start.cast("int").alias("de"), end.cast("int").alias("ate"), *[c.alias(n) for n, c in zip(columns, state)])

    own = span(F.col("rodada"), F.coalesce(F.col("_next") - 1, F.col("_last")), [F.col(c) for c in columns])
    blank = [F.lit(values[c]).cast(states.schema[c].dataType) for c in columns]
    earlier = span(F.lit(1), F.when(F.col("_first"), F.col("rodada") - 1).otherwise(0), blank)
    return spans.select(*key, "clube_id", F.inline(F.array(earlier, own))).filter("de <= ate")


def cells(spans: DataFrame, rounds: DataFrame | None = None, key: Sequence[str] = KEY) -> DataFrame:
    """A row for every round of the intervals, or only for the ``rounds`` (key, rodada) asked for.

    Each interval explodes into its own rounds: no product of rounds and clubs, no range join. The rounds asked for travel as one
    array per competition, which is no longer than the calendar, and an interval takes its own out of it.
    """
    columns = [c for c in spans.columns if c not in (*key, "clube_id", "de", "ate")]
    if rounds is None:
        held, own = spans, F.sequence("de", "ate")
    else:
        asked = rounds.groupBy(*key).agg(F.collect_set(F.col("rodada").cast("int")).alias("_pedidas"))
        renamed = asked.withColumnsRenamed({c: f"_k_{c}" for c in key})
        held = spans.join(renamed, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in key])
        own = F.filter("_pedidas", lambda r: (r >= F.col("de")) & (r <= F.col("ate")))
    return held.select(*key, "clube_id", F.explode(own).alias("rodada"), *columns)

