"""Training set, its split by time and its class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from matchweave.functions.numeric import clock_micros
from matchweave.operators.clean import played
from matchweave.operators.clubrows import by_club
from matchweave.operators.joins import FEATURES, join_features, join_match_features
from matchweave.operators.latest import KEY

MIN_ROWS = 10


def training_set(
    matches: DataFrame, enhanced: DataFrame, base: DataFrame, key: Sequence[str] = KEY, lagged: bool = False
) -> DataFrame:
    """Played matches with 14 features; rows with any missing feature are dropped.

    The goal difference of a round contains the match to predict. ``lagged`` takes the
    one of the club's previous round instead.
    """
    if lagged:
        before = F.lag("saldo_gols").over(by_club(key, ("rodada",)))
        base = base.withColumn("saldo_gols", F.coalesce(before, F.lit(0)))
    state = join_features(enhanced, base, key)
    facts = played(matches).select(
        *key, "partida_id", "rodada", "data_partida", "clube_casa_id", "clube_vis_id", "resultado"
    )
    return join_match_features(facts, state, key).dropna(subset=FEATURES)


def training_rows(matches: DataFrame, state: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Played matches with the features of both clubs as they were before the match; ``state`` is one row per match and club."""
    facts = played(matches).select(
        *key, "partida_id", "rodada", "data_partida", "clube_casa_id", "clube_vis_id", "resultado"
    )
    return join_match_features(facts, state, key, on=("partida_id",)).dropna(subset=FEATURES)


def _ordinals() -> list[Column]:
    """The order rows are split in, as integers; what is missing comes first, as a value of its own."""
    values = [F.col("rodada").cast("bigint"), clock_micros(F.col("data_partida")), F.col("partida_id").cast("bigint")]
    return [part for v in values for part in (v.isNotNull().cast("bigint"), F.coalesce(v, F.lit(0)))]


def _value_at(rows: DataFrame, value: Column, position: int, width: int = 1024) -> tuple[int, int]:
    """The ``position``-th smallest integer (from 1) and how many rows are below it.

    Each pass counts the rows per slice of the value range, at most ``width`` slices, and
    goes on inside the slice that holds the position. The driver sees the slice counts
    only; no task sorts anything, so one hot value does no harm.
    """
    numbers = rows.select(value.alias("v"))
    low, high = numbers.agg(F.min("v"), F.max("v")).first()
    below = 0
    while low < high:
        size = (high - low) // width + 1
        wide = "bigint" if high - low < 2**63 else "decimal(38,0)"  # hashed ids span all of bigint
        slice_no = F.expr(f"(CAST(v AS {wide}) - CAST('{low}' AS {wide})) div CAST('{size}' AS {wide})")
        within = numbers.filter(F.col("v").between(low, high))
        slices = within.groupBy(slice_no.cast("bigint").alias("slice")).count().orderBy("slice").collect()
        for s in slices:
            if below + s["count"] >= position:
                low, high = low + s["slice"] * size, min(high, low + (s["slice"] + 1) * size - 1)
                break
            below += s["count"]
    return low, below


def split_boundary(rows: DataFrame, share: float = 0.8) -> tuple[int, tuple[int, ...]]:
    """Size of the first part and the ordinals of its last row."""
    size = int(rows.count() * share)
    left, boundary, current = size, [], rows
    for value in _ordinals():
        if size == 0:
            break
        found, below = _value_at(current, value, left)
        boundary.append(found)
        left -= below
        current = current.filter(value == found)
    return size, tuple(boundary)


def time_split(rows: DataFrame, share: float = 0.8) -> DataFrame:
    """Mark the first ``int(share * n)`` rows in time ``treino``, the rest ``teste``.

    ``rows`` is read several times; pass a written table.
    """
    size, boundary = split_boundary(rows, share)
    if size == 0:
        return rows.withColumn("conjunto", F.lit("teste"))
    last = F.struct(*[F.lit(v).cast("bigint") for v in boundary])
    return rows.withColumn("conjunto", F.when(F.struct(*_ordinals()) <= last, "treino").otherwise("teste"))


def class_weights(rows: DataFrame, label: str = "resultado") -> DataFrame:
    """n / (classes x n of the class), per class. One row per label value."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k")).alias("t"))
    n, k = (total.select(f"t.{c}").scalar() for c in ("n", "k"))
    return counts.select(label, "n", (n / (k * F.col("n"))).alias("peso"))


def enough_rows(rows: DataFrame, n: int = MIN_ROWS) -> bool:
    """Looks at ``n`` rows at most."""
    return rows.limit(n).count() >= n
