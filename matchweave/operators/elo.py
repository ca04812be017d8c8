"""Elo ratings: sequential, additive and simplified.

The sequential rating of a match needs both clubs' ratings after all their earlier
matches, so it is no window. ``elo`` has two methods with the same results; the caller names one:

* ``grouped``: a task reads a competition's calendar in order, batch by batch, about ``SLICE`` matches at most.
  A competition of more is rated slice after slice, with the ratings handed on in a written table;
* ``levels``: for a competition that no task should hold. Matches of a level share no club, so a level
  is a join of its matches with the ratings they wait for, spread over the cluster. The number
  of levels follows the calendar, the work per level follows its matches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from matchweave.functions.numeric import half_up
from matchweave.functions.scoring import AWAY, DRAW, HOME
from matchweave.operators.clean import played
from matchweave.operators.clubrows import START, by_club, over_clubs
from matchweave.operators.latest import KEY
from matchweave.session import scratch_path, stage

K_FACTOR = 32
START_RATING = 1500.0
SCALE = 400.0

#: Matches of a competition that one task sorts.
SLICE = 2_000_000
SCORES = {HOME: 1.0, DRAW: 0.5, AWAY: 0.0}

PRE = ("elo_casa", "elo_vis")
POST = ("elo_casa_depois", "elo_vis_depois")
LINE = "_linha"
#: Dates first, undated matches last; the line decides between rows that agree in everything.
ORDER = ["data_partida", "partida_id", "clube_casa_id", "clube_vis_id", LINE]


def elo(
    matches: DataFrame,
    key: Sequence[str] = KEY,
    k: float = K_FACTOR,
    start: float = START_RATING,
    method: str = "grouped",
    after: bool = False,
) -> DataFrame:
    """Played matches with both clubs' ratings before the match, with ``after`` also after it.

    Order: ``data_partida`` (undated last), then ``partida_id``. The matches are written once to the shared
    folder with a line number, which the ratings are joined back on; repeated ids and match keys do no harm.
    """
    lines = stage(played(matches).withColumn(LINE, F.monotonically_increasing_id()), "elo_input")
    facts = lines.select(*key, LINE, "data_partida", "partida_id", "clube_casa_id", "clube_vis_id", "resultado")
    rated = {"grouped": _grouped, "levels": _by_level}[method](facts, key, k, start)
    joined = lines.join(stage(rated, "elo_rated"), LINE)
    post = dict(zip(POST, _moved(k))) if after else {}
    return joined.select(*matches.columns, *PRE, *[c.alias(name) for name, c in post.items()])


def _moved(k: float) -> tuple[Column, Column]:
    """Both ratings after a match, from those before it and the result."""
    home, away = (F.col(c) for c in PRE)
    score = F.when(F.col("resultado") == HOME, 1.0).when(F.col("resultado") == DRAW, 0.5).otherwise(0.0)
    expected = 1 / (1 + F.pow(F.lit(10.0), (away - home) / SCALE))
    return home + k * (score - expected), away + k * ((1 - score) - (1 - expected))


def _rater(k: float, start: float):
    def rate(matches: Sequence[tuple], ratings: dict[int, float]) -> list[tuple[float, float]]:
        """Ratings before each match (home, away, result) in order; ``ratings`` holds those before the first and then those after the last."""
        before: list[tuple[float, float]] = []
        for home, away, result in matches:
            pair = ratings.get(home, start), ratings.get(away, start)
            before.append(pair)
            score = SCORES.get(result, math.nan)
            expected = 1 / (1 + 10 ** ((pair[1] - pair[0]) / SCALE))
            ratings[home] = pair[0] + k * (score - expected)
            ratings[away] = pair[1] + k * ((1 - score) - (1 - expected))
            if home is None or away is None:
                ratings.pop(None, None)  # an unknown club is no one's equal
        return before

    return rate


def _runs(batch: pa.RecordBatch, group: Sequence[str]) -> Iterator[tuple[list, int, int]]:
    """(key, first row, end) of each run of rows of one group."""
    codes = [batch.column(c).dictionary_encode("encode").indices.to_numpy() for c in group]
    cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in codes])) + 1
    for first, end in pairwise([0, *cuts.tolist(), batch.num_rows]):
        yield [batch.column(c)[first].as_py() for c in group], first, end


def in_order(facts: DataFrame, group: Sequence[str], k: float, start: float, held: DataFrame | None = None) -> DataFrame:
    """(group, line, both ratings before the match) of each match, the matches of a group one after the other.

    Spark sorts a group, spilling where it must, and hands its rows over in batches, so Python holds a batch and the ratings of one
    group's clubs, whatever the number of matches or of groups. ``held`` has the ratings before the first match (group, _clube, _elo);
    with it those after the last follow, as rows without a line (group, _clube, the rating as that of the home club).
    """
    rate, handed_on = _rater(k, start), held is not None
    rows = facts.select(*group, *[F.col(c).cast("bigint") if c.startswith("clube_") else c for c in ORDER], "resultado")
    if handed_on:
        rows = rows.unionByName(held.select(*group, F.col("_clube").alias("clube_casa_id"), "_elo"), allowMissingColumns=True)
    else:
        rows = rows.withColumn("_elo", F.lit(None).cast("double"))
    out = T.StructType([facts.schema[c] for c in group]).add(LINE, "long").add("_clube", "long").add(PRE[0], "double").add(PRE[1], "double")

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ratings, kinds = None, {}, []

        def after(ended: list[tuple[list, dict[int, float]]]) -> Iterator[pa.RecordBatch]:
            ended = [(key, known) for key, known in ended if known]
            if handed_on and ended:
                keys = [pa.array([key[i] for key, known in ended for _ in known], kind) for i, kind in enumerate(kinds)]
                clubs, values = ([x for _, known in ended for x in part(known)] for part in (dict.keys, dict.values))
                yield pa.RecordBatch.from_arrays([*keys, pa.nulls(len(clubs), pa.int64()), pa.array(clubs, pa.int64()), pa.array(values, pa.float64()), pa.nulls(len(clubs), pa.float64())], names=out.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.schema.field(c).type for c in group]
            line, home, away, result, elo_held = (batch.column(c).to_pylist() for c in (LINE, "clube_casa_id", "clube_vis_id", "resultado", "_elo"))
            before, ended = [], []
            for key, at, end in _runs(batch, group):
                if now is None or repr(now) != repr(key):
                    ended.append((now, ratings))
                    now, ratings = key, {}
                while at < end and line[at] is None:
                    ratings[home[at]] = elo_held[at]
                    at += 1
                before += rate(list(zip(home[at:end], away[at:end], result[at:end])), ratings)
            matches = batch.filter(pc.is_valid(batch.column(LINE)))
            pairs = [pa.array([pair[side] for pair in before], pa.float64()) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([*[matches.column(c) for c in (*group, LINE)], pa.nulls(len(before), pa.int64()), *pairs], names=out.names)
            yield from after(ended)
        yield from after([(now, ratings)])

    dealt = rows.repartition(*group) if group else rows.repartition(1)
    ordered = dealt.sortWithinPartitions(*[F.asc_nulls_last(c) for c in group], F.col(LINE).isNotNull(), *[F.asc_nulls_last(c) for c in ORDER])
    return ordered.select(*group, LINE, "clube_casa_id", "clube_vis_id", "resultado", "_elo").mapInArrow(rated, out)


def _grouped(facts: DataFrame, key: Sequence[str], k: float, start: float) -> DataFrame:
    most = facts.groupBy(*key).count().agg(F.max("count"), F.sum("count")).first()
    if (most[0] or 0) <= SLICE:
        return in_order(facts, key, k, start).select(LINE, *PRE)
    return _by_slice(facts, key, k, start, -(-most[1] // SLICE)).select(LINE, *PRE)


def _by_slice(facts: DataFrame, key: Sequence[str], k: float, start: float, slices: int) -> DataFrame:
    """Ranges of (competition, order) are slices; pass n rates the n-th of every competition, from the ratings of the passes before.

    A task gets a slice's matches and the ratings of its clubs. The passes are as many as the slices of the longest competition, and
    each reads its own slices only.
    """
    spark = facts.sparkSession
    order = [F.asc_nulls_last(c) for c in (*key, *ORDER)]
    ranged = stage(facts.repartitionByRange(slices, *order).withColumn("_faixa", F.spark_partition_id()), "elo_ranges")
    first = ranged.groupBy(*[F.col(c).alias(f"_k{n}") for n, c in enumerate(key)]).agg(F.min("_faixa").alias("_primeira"))
    same = [F.col(c).eqNullSafe(F.col(f"_k{n}")) for n, c in enumerate(key)]
    numbered = ranged.join(first, same).withColumn("_fatia", F.col("_faixa") - F.col("_primeira")).select(*facts.columns, "_fatia")
    path = scratch_path(spark, "elo_slices")
    numbered.write.partitionBy("_fatia").parquet(path)
    passes = numbered.agg(F.max("_fatia")).first()[0] + 1
    held = T.StructType([facts.schema[c] for c in key]).add("_clube", "long").add("_elo", "double")
    ratings = spark.createDataFrame([], held)
    done = []
    for n in range(passes):
        todo = spark.read.schema(facts.schema).parquet(f"{path}/_fatia={n}")
        clubs = todo.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], F.explode(F.array(F.col("clube_casa_id").cast("bigint"), F.col("clube_vis_id").cast("bigint"))).alias("_c"))
        own = ratings.join(clubs, [*same, F.col("_clube") == F.col("_c")], "left_semi")
        rated = stage(in_order(todo, key, k, start, own), "elo_slice")
        done.append(rated.filter(F.col(LINE).isNotNull()))
        new = rated.filter(F.col(LINE).isNull()).select(*key, "_clube", F.col(PRE[0]).alias("_elo"))
        moved = new.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], F.col("_clube").alias("_c"))
        ratings = stage(ratings.join(moved, [*same, F.col("_clube") == F.col("_c")], "left_anti").unionByName(new), "elo_ratings")
    return reduce(DataFrame.unionByName, done)


def levels(facts: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """(line, level, and for each side the next line and its level): a level holds no club twice and follows each club's order.

    A match's level is one above the higher of its clubs' previous matches. It starts at the number of the match
    in the longer of the two calendars, which is never too high, and rises until nothing changes. Previous
    matches come strictly earlier in one order of all lines, so that ends, at the latest after as many passes as the last
    level; calendars in step need very few.
    """
    order = Window.partitionBy(*key, "_clube").orderBy(*[F.asc_nulls_last(c) for c in ORDER])
    sides = facts.select(*key, *ORDER, F.posexplode(F.array("clube_casa_id", "clube_vis_id")).alias("_lado", "_clube"))
    placed = sides.withColumns({
        "_n": F.row_number().over(order), "_antes": F.lag(LINE).over(order), "_depois": F.lead(LINE).over(order),
    }).select(LINE, "_lado", "_n", "_antes", "_depois")
    placed = stage(placed, "elo_sides")
    level = stage(placed.groupBy(LINE).agg(F.max("_n").cast("int").alias("_nivel")), "elo_levels")
    waits = placed.filter("_antes IS NOT NULL").select(LINE, "_antes")
    while True:
        earlier = level.select(F.col(LINE).alias("_antes"), F.col("_nivel").alias("_anterior"))
        needed = waits.join(earlier, "_antes").groupBy(LINE).agg((F.max("_anterior") + 1).alias("_minimo"))
        raised = level.join(needed, LINE, "left")
        if raised.filter("_minimo > _nivel").isEmpty():
            break
        level = stage(raised.select(LINE, F.greatest("_nivel", F.coalesce("_minimo", "_nivel")).alias("_nivel")), "elo_levels")
    following = level.select(F.col(LINE).alias("_depois"), F.col("_nivel").alias("_nivel_depois"))
    ahead = placed.join(following, "_depois", "left").groupBy(LINE).agg(*[
        F.max(F.when(F.col("_lado") == side, F.col(column))).alias(f"{column}_{side}")
        for side in (0, 1) for column in ("_depois", "_nivel_depois")
    ])
    return level.join(ahead, LINE)


def _by_level(facts: DataFrame, key: Sequence[str], k: float, start: float) -> DataFrame:
    """Each level reads the ratings that wait for it and hands the new ones on to the levels of the clubs' next matches."""
    spark = facts.sparkSession
    root = scratch_path(spark, "elo")
    rated_schema = f"{LINE} bigint, {PRE[0]} double, {PRE[1]} double"
    numbered = facts.select(LINE, "clube_casa_id", "clube_vis_id", "resultado").join(levels(facts, key), LINE)
    numbered.repartition("_nivel", F.hash(LINE) % 64).write.partitionBy("_nivel").parquet(f"{root}/partidas")
    numbered = spark.read.schema(numbered.schema).parquet(f"{root}/partidas")
    last = numbered.agg(F.max("_nivel")).first()[0] or 0
    waiting = f"{LINE} bigint, _clube bigint, _elo double"
    paths = []
    for level in range(1, last + 1):
        todo = numbered.filter(F.col("_nivel") == level)
        if level > 1:
            ready = spark.read.schema(waiting).parquet(f"{root}/esperam/_para={level}")
            for side, name in zip(("clube_casa_id", "clube_vis_id"), PRE):
                own = ready.select(LINE, F.col("_clube").alias(side), F.col("_elo").alias(name))
                todo = todo.join(own, [LINE, side], "left")
        else:
            todo = todo.withColumns({name: F.lit(None).cast("double") for name in PRE})
        todo = stage(todo.withColumns({name: F.coalesce(name, F.lit(float(start))) for name in PRE}), "elo_level")
        paths.append(f"{root}/prontas/nivel={level}")
        todo.select(LINE, *PRE).write.parquet(paths[-1])
        home, away = _moved(k)
        handed = todo.select(F.inline(F.array(*[
            F.struct(F.col(f"_depois_{side}").alias(LINE), F.col(club).cast("bigint").alias("_clube"), rating.alias("_elo"), F.col(f"_nivel_depois_{side}").alias("_para"))
            for side, club, rating in ((0, "clube_casa_id", home), (1, "clube_vis_id", away))
        ]))).filter(f"{LINE} IS NOT NULL")
        handed.write.mode("append").partitionBy("_para").parquet(f"{root}/esperam")
    if not paths:
        return spark.createDataFrame([], rated_schema)
    return spark.read.schema(rated_schema).parquet(*paths)


# Rating change per match of the additive variant, as a share of its k.
WIN_SHARE, DRAW_SHARE = 0.7, 0.1


def additive_delta(k: float = 30) -> Column:
    """Rating change of one club row: fixed for win and loss; a draw favours the home side."""
    draw = F.when(F.col("eh_casa"), k * DRAW_SHARE).otherwise(-k * DRAW_SHARE)
    return F.when(F.col("vitoria") == 1, k * WIN_SHARE).when(F.col("derrota") == 1, -k * WIN_SHARE).otherwise(draw)


def additive_total(key: Sequence[str] = KEY) -> Column:
    """All changes so far; needs the column ``_delta``."""
    return F.sum("_delta").over(by_club(key).rowsBetween(START, 0))


def elo_additive(
    rows: DataFrame, base: DataFrame, keep: Sequence[str], key: Sequence[str] = KEY, k: float = 30
) -> DataFrame:
    """Post-match rating: the club's base plus all its changes so far. A plain window.

    ``base`` has (clube_id, elo_base); a club without one starts at ``START_RATING``.
    """
    moved = over_clubs(rows.withColumn("_delta", additive_delta(k)), {"_moved": additive_total(key)}, keep, key)
    start = F.coalesce("elo_base", F.lit(START_RATING))
    based = moved.join(base.select("clube_id", "elo_base"), "clube_id", "left")
    return based.select(*keep, half_up(start + F.col("_moved"), 2).alias("elo_rating"))


# Weights and defaults of the simplified rating.
HOME_WEIGHT, AWAY_WEIGHT, FORM_WEIGHT = 200, 100, 50
RATE_DEFAULT, FORM_DEFAULT = 0.33, 1.0


def elo_simplified(home_rate: Column, away_rate: Column, form: Column) -> Column:
    """Start rating plus weighted venue rates and form; nulls take the defaults."""
    bonus = (
        F.coalesce(home_rate, F.lit(RATE_DEFAULT)) * HOME_WEIGHT
        + F.coalesce(away_rate, F.lit(RATE_DEFAULT)) * AWAY_WEIGHT
        + F.coalesce(form, F.lit(FORM_DEFAULT)) * FORM_WEIGHT
    )
    return START_RATING + bonus
