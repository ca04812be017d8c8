"""One row per key, and windows whose groups have a proven size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

KEY = ("competicao",)
MATCH_KEY = ("rodada", "clube_casa_id", "clube_vis_id")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, nulls lowest.

    A max over a struct combines on the map side, so a key that owns a third of the
    rows still sends one row per map task. A ``row_number`` filter would sort them all
    in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_newest")
    picked = df.groupBy(*keys).agg(newest)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_newest.{c}") for c in df.columns])


def append_dedupe(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Append ``new`` and keep the latest row per key; on equal order the new row wins."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    return latest_per_key(both, keys, [*order, "_batch"]).drop("_batch")


def rank_within(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    tiebreak: str,
    name: str,
    chunk: int = 1_000_000,
) -> DataFrame:
    """``row_number`` per key by ``order`` descending, then ``tiebreak`` ascending.

    ``tiebreak`` is an integer, unique within the key. The obvious window would sort a
    whole key in one task. Here the rows are numbered only inside buckets of equal
    ``order`` values and one id range of ``chunk``, so no task sorts more than ``chunk``
    rows; the rows ahead of a bucket are added from the bucket sizes. Those sizes are
    summed in two steps, first per leading value, then within it.
    """
    lead, rest = order[0], list(order[1:])
    bucket = [*key, *order, "_chunk"]
    chunked = df.withColumn("_chunk", F.expr(f"{tiebreak} div {chunk}"))
    sizes = chunked.groupBy(*bucket).agg(F.count("*").alias("_size"))

    def before(window):
        total = F.sum("_size").over(window.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(total, F.lit(0))

    by_lead = Window.partitionBy(*key).orderBy(F.desc(lead))
    in_lead = Window.partitionBy(*key, lead).orderBy(*[F.desc(c) for c in rest], "_chunk")
    leads = sizes.groupBy(*key, lead).agg(F.sum("_size").alias("_size"))
    leads = leads.select(*key, lead, before(by_lead).alias("_ahead"))
    within = sizes.select(*bucket, before(in_lead).alias("_inside"))
    offsets = _same(within, leads, [*key, lead]).select(*bucket, (F.col("_ahead") + F.col("_inside")).alias("_offset"))

    place = F.row_number().over(Window.partitionBy(*bucket).orderBy(tiebreak))
    numbered = chunked.withColumn("_place", place)
    return _same(numbered, offsets, bucket).select(
        *df.columns, (F.col("_offset") + F.col("_place")).cast("int").alias(name)
    )


def _same(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on equal or both null columns, keeping ``left``'s.

    Besides keeping rows with nulls, it adds no null filter below either side, so the
    branches of ``rank_within`` stay the same plan and read their input's exchange once.
    """
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    joined = left.join(renamed, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return joined.drop(*[f"_r_{c}" for c in on])
