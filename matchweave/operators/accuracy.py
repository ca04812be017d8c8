"""Evaluation of predictions: accuracy by round, by class, over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from matchweave.functions.numeric import half_up, pct, ratio_pct
from matchweave.functions.scoring import AWAY, DRAW, HOME, hit
from matchweave.operators.latest import KEY

CLASSES = (HOME, DRAW, AWAY)


def _hits() -> Column:
    return F.sum(F.col("acerto").cast("int"))


def _share(flag: Column) -> Column:
    """Mean of a 0/1 flag over its known rows, from exact sums."""
    return F.sum(flag.cast("int")) / F.nullif(F.count(flag), F.lit(0))


def by_round_measures() -> dict[str, Column]:
    return {
        "total_jogos": F.count("*"),
        "acertos": F.coalesce(_hits(), F.lit(0)),
        "acuracia_pct": ratio_pct(F.coalesce(_hits(), F.lit(0)), F.count("*"), 1),
    }


def by_class_measures() -> dict[str, Column]:
    """Accuracy among the matches that ended in each class; null if none did."""
    return {
        f"acuracia_{c}_pct": pct(_share(F.when(F.col("resultado_real") == c, F.coalesce("acerto", F.lit(False)))))
        for c in CLASSES
    }


def confidence_measures() -> dict[str, Column]:
    """Mean ``prob_casa`` on hits and on misses; exact sums, so the order of rows is irrelevant."""
    def mean(condition: Column) -> Column:
        value = F.when(condition, F.col("prob_casa").cast("decimal(18,10)"))
        return half_up(F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0)) * 100, 1)

    return {"conf_media_acerto": mean(F.col("acerto")), "conf_media_erro": mean(~F.col("acerto"))}


def _by_round(validated: DataFrame, key: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    return validated.groupBy(*key, "rodada").agg(*[c.alias(n) for n, c in measures.items()])


def accuracy_by_round(validated: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return _by_round(validated, key, by_round_measures())


def accuracy_by_class(validated: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return _by_round(validated, key, by_class_measures())


def confidence_hit_miss(validated: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return _by_round(validated, key, confidence_measures())


def accuracy_view(validated: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Accuracy from comparing prediction and result, not from the stored flag."""
    compared = validated.withColumn("acerto", hit())
    return accuracy_by_round(compared, key).withColumnRenamed("total_jogos", "partidas")


def accuracy_moving(by_round: DataFrame, key: Sequence[str] = KEY, n: int = 5) -> DataFrame:
    """Moving mean and running totals over the rounds: one row per round, so small groups."""
    rounds = Window.partitionBy(*key).orderBy("rodada")
    so_far = rounds.rowsBetween(Window.unboundedPreceding, 0)
    moving = F.sum(F.col("acuracia_pct").cast("decimal(18,4)")).over(rounds.rowsBetween(1 - n, 0)).cast("double")
    known = F.count("acuracia_pct").over(rounds.rowsBetween(1 - n, 0))
    totals = by_round.withColumns(
        {
            "acuracia_media_5r": half_up(moving / known, 1),
            "total_jogos_acumulado": F.sum("total_jogos").over(so_far),
            "acertos_acumulado": F.sum("acertos").over(so_far),
        }
    )
    overall = ratio_pct(F.col("acertos_acumulado"), F.col("total_jogos_acumulado"), 1)
    return totals.withColumn("acuracia_geral_pct", overall)


def mart_performance(validated: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Published model performance: one aggregation, then windows over its rounds."""
    measures = by_round_measures() | by_class_measures() | confidence_measures()
    return accuracy_moving(_by_round(validated, key, measures), key)


def round_counts(validated: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Counts and exact sums by round and result, from which every measure of a round follows: the table to keep.

    Counts of disjoint sets of predictions add up, and a round's counts replace its old ones (``merge_counts``).
    """
    sure = F.col("prob_casa").cast("decimal(18,10)")
    sums = {}
    for name, condition in (("acerto", F.col("acerto")), ("erro", ~F.col("acerto"))):
        value = F.when(condition, sure)
        sums |= {f"soma_{name}": F.sum(value), f"n_{name}": F.count(value)}
    hits = {"n": F.count("*"), "acertos": F.coalesce(_hits(), F.lit(0))}
    return _by_round_and(validated, key, "resultado_real", hits | sums)


def _by_round_and(rows: DataFrame, key: Sequence[str], column: str, measures: dict[str, Column]) -> DataFrame:
    return rows.groupBy(*key, "rodada", column).agg(*[c.alias(n) for n, c in measures.items()])


def merge_counts(old: DataFrame, new: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """``old`` with the rounds of ``new`` in the place of its own; no other round is touched."""
    on = [*key, "rodada"]
    renamed = new.select(*[F.col(c).alias(f"_n_{c}") for c in on]).distinct()
    kept = old.join(renamed, [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in on], "left_anti")
    return kept.unionByName(new.select(*old.columns))


def performance_from_counts(counts: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """``mart_performance`` from the counts of each round."""
    def total(name: str, where: Column | None = None) -> Column:
        return F.coalesce(F.sum(F.col(name) if where is None else F.when(where, F.col(name))), F.lit(0))

    measures = {
        "total_jogos": total("n"),
        "acertos": total("acertos"),
        "acuracia_pct": ratio_pct(total("acertos"), total("n"), 1),
    }
    for c in CLASSES:
        own = F.col("resultado_real") == c
        measures[f"acuracia_{c}_pct"] = pct(total("acertos", own) / F.nullif(total("n", own), F.lit(0)))
    for name in ("acerto", "erro"):
        measures[f"conf_media_{name}"] = half_up(F.sum(f"soma_{name}").cast("double") / F.nullif(total(f"n_{name}"), F.lit(0)) * 100, 1)
    return accuracy_moving(_by_round(counts, key, measures), key)


def validate_predictions(joined: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Published shape of predictions joined with their results."""
    return joined.withColumn("acerto", hit()).select(
        *key, "rodada", "clube_casa_id", "clube_vis_id", "nome_casa", "nome_vis",
        "previsao", "resultado_real", "acerto", "prob_casa", "prob_empate", "prob_visitante",
    )


def prediction_metrics(scored: DataFrame, floor: float = 1e-15) -> DataFrame:
    """Accuracy, support-weighted F1 and log loss as plain aggregates, in one row."""
    of_actual = [F.when(F.col("resultado_real") == c, F.col(f"prob_{c}")) for c in CLASSES]
    chosen = F.least(F.greatest(F.coalesce(*of_actual), F.lit(floor)), F.lit(1 - floor))
    one = F.lit(1)
    counts = {"n": F.count("*"), "right": F.sum(hit().cast("int")), "loss": F.sum(-F.log(chosen))}
    for c in CLASSES:
        counts[f"real_{c}"] = F.count(F.when(F.col("resultado_real") == c, one))
        counts[f"dito_{c}"] = F.count(F.when(F.col("previsao") == c, one))
        counts[f"certo_{c}"] = F.count(F.when(hit() & (F.col("previsao") == c), one))
    row = scored.agg(*[c.alias(n) for n, c in counts.items()])
    f1 = sum(
        (
            F.coalesce(
                2 * F.col(f"certo_{c}") / F.nullif(F.col(f"real_{c}") + F.col(f"dito_{c}"), F.lit(0)), F.lit(0.0)
            )
            * F.col(f"real_{c}")
            for c in CLASSES
        ),
        F.lit(0.0),
    ) / F.col("n")
    return row.select(
        F.col("n").alias("amostras"),
        half_up(F.col("right") / F.col("n"), 6).alias("acuracia"),
        half_up(f1, 6).alias("f1_score"),
        half_up(F.col("loss") / F.col("n"), 6).alias("log_loss"),
    )
