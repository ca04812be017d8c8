"""Data-quality checks. Each returns report rows in the published shape."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from matchweave.functions.scoring import AWAY, DRAW, HOME
from matchweave.operators.latest import KEY, MATCH_KEY

REPORT = ("check_name", "tabela", "status", "records_checked", "records_failed", "detalhe")


def conditions(df: DataFrame, table: str, failing: dict[str, Column], severity: str = "failed") -> DataFrame:
    """All conditions of a table in one scan: a conditional sum each, then one row each."""
    sums = [F.sum(F.when(c, 1).otherwise(0)).alias(f"_{i}") for i, c in enumerate(failing.values())]
    totals = df.agg(F.count("*").alias("_n"), *sums)
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), F.coalesce(f"_{i}", F.lit(0)).cast("bigint").alias("records_failed"))
            for i, name in enumerate(failing)
        ]
    )
    return _report(totals.select("_n", F.inline(rows)), table, severity)


class Observed:
    """Conditions of a table counted while it is written, so that no check reads it again.

    ``rules`` are (severity, name -> failing condition). Wrap what is written in ``of``; after the write ``report`` has the rows that
    ``conditions`` would give. ``unique`` names keys whose failed values come from one count over the keys alone.
    """

    def __init__(self, table: str, rules: Sequence[tuple[str, dict[str, Column]]], unique: Sequence[Sequence[str]] = ()):
        self.table, self.unique, self.seen = table, unique, Observation()
        self.rules = [(severity, name, failing) for severity, named in rules for name, failing in named.items()]

    def of(self, df: DataFrame) -> DataFrame:
        sums = [F.coalesce(F.sum(F.when(failing, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(f"r{n}") for n, (_, _, failing) in enumerate(self.rules)]
        return df.observe(self.seen, F.count(F.lit(1)).alias("n"), *sums)

    def report(self, written: DataFrame) -> DataFrame:
        """The rows of all conditions, from the numbers observed, and of the unique keys of what was ``written``."""
        got, spark = self.seen.get, written.sparkSession
        rows = [(name, self.table, "success" if not got[f"r{n}"] else severity, got["n"], got[f"r{n}"], f"{got[f'r{n}']} de {got['n']}") for n, (severity, name, _) in enumerate(self.rules)]
        counted = spark.createDataFrame(rows, "check_name string, tabela string, status string, records_checked bigint, records_failed bigint, detalhe string")
        return union_reports(counted, *[dq_unique(written, self.table, keys) for keys in self.unique])


def _report(counts: DataFrame, table: str, severity: str) -> DataFrame:
    failed = F.col("records_failed")
    return counts.select(
        "check_name", F.lit(table).alias("tabela"),
        F.when(failed == 0, "success").otherwise(severity).alias("status"),
        F.col("_n").alias("records_checked"), "records_failed",
        F.concat(failed.cast("string"), F.lit(" de "), F.col("_n").cast("string")).alias("detalhe"),
    )


def union_reports(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def dq_row_count(df: DataFrame, table: str, name: str) -> DataFrame:
    """Warning when the table is empty."""
    n = F.col("_n")
    return df.agg(F.count("*").alias("_n")).select(
        F.lit(name).alias("check_name"), F.lit(table).alias("tabela"),
        F.when(n > 0, "success").otherwise("warning").alias("status"),
        n.alias("records_checked"), F.lit(0).cast("bigint").alias("records_failed"),
        F.concat(n.cast("string"), F.lit(" registros")).alias("detalhe"),
    )


def not_null(columns: Sequence[str]) -> dict[str, Column]:
    return {f"not_null_{c}": F.col(c).isNull() for c in columns}


def dq_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return conditions(df, table, not_null(columns))


def dq_unique(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Failed = values that occur more than once. Counts per value combine on the map side."""
    known = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("_c"))
    counts = known.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).alias("_n"),
        F.count(F.when(F.col("_c") > 1, 1)).alias("records_failed"),
    )
    return _report(counts.withColumn("check_name", F.lit("unique_" + "_".join(columns))), table, "failed")


def accepted(column: str, values: Sequence[str]) -> dict[str, Column]:
    return {f"accepted_values_{column}": F.coalesce(~F.col(column).isin(*values), F.lit(False))}


def dq_accepted(df: DataFrame, table: str, column: str, values: Sequence[str], where: Column | None = None) -> DataFrame:
    return conditions(df if where is None else df.filter(where), table, accepted(column, values))


def in_range(column: str, low: float, high: float) -> dict[str, Column]:
    return {f"accepted_range_{column}": F.coalesce(~F.col(column).between(low, high), F.lit(False))}


def dq_range(df: DataFrame, table: str, column: str, low: float, high: float, severity: str = "warning") -> DataFrame:
    return conditions(df, table, in_range(column, low, high), severity)


def prob_sum(tolerance: float = 0.01) -> dict[str, Column]:
    total = F.col("prob_casa") + F.col("prob_empate") + F.col("prob_visitante")
    return {"prob_soma_1": F.abs(total - 1.0) > tolerance}


def dq_prob_sum(predictions: DataFrame, table: str, tolerance: float = 0.01) -> DataFrame:
    return conditions(predictions, table, prob_sum(tolerance))


def bounds(rules: dict[str, tuple[float | None, float | None]]) -> dict[str, Column]:
    """Rules: column -> (least, greatest), either open."""
    failing = {}
    for column, (low, high) in rules.items():
        bad = F.lit(False)
        bad = bad if low is None else bad | (F.col(column) < low)
        bad = bad if high is None else bad | (F.col(column) > high)
        failing[f"limites_{column}"] = F.coalesce(bad, F.lit(False))
    return failing


def dq_bounds(df: DataFrame, table: str, rules: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    return conditions(df, table, bounds(rules))


def dq_positions(table: DataFrame, key: Sequence[str] = KEY, expected_clubs: int | None = None) -> DataFrame:
    """Per competition: places run 1..n without gap or repeat; optionally n itself.

    Different places are counted, since sums do not tell 1, 1, 4, 4, 5 from 1..5. Equal places combine before a competition's are counted.
    """
    places = table.groupBy(*key).agg(
        F.min("posicao").alias("primeira"), F.max("posicao").alias("ultima"),
        F.count("*").alias("clubes"), F.count_distinct("posicao").alias("_places"),
    )
    clubs = F.col("clubes")
    sequential = (F.col("primeira") == 1) & (F.col("ultima") == clubs) & (F.col("_places") == clubs)
    good = sequential if expected_clubs is None else sequential & (clubs == expected_clubs)
    return places.select(*key, "primeira", "ultima", "clubes", F.when(good, "success").otherwise("failed").alias("status"))


def dq_match_keys(matches: DataFrame, table: str = "silver.partidas", key: Sequence[str] = KEY) -> DataFrame:
    """Required fields, valid scores and results, repeated match keys."""
    bad_score = (F.col("placar_casa") < 0) | (F.col("placar_vis") < 0)
    invalid = ~F.col("resultado").isin(HOME, DRAW, AWAY)
    unscored = F.col("placar_casa").isNull() | F.col("placar_vis").isNull()
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in MATCH_KEY])
    fields = {
        "sem_nulos": missing, "placar_valido": bad_score, "resultado_valido": invalid, "sem_placar": unscored,
    }
    return union_reports(conditions(matches, table, fields), dq_unique(matches, table, [*key, *MATCH_KEY]))


def dq_elo_range(store: DataFrame, table: str, low: float = 1300, high: float = 1800) -> DataFrame:
    return dq_bounds(store, table, {"elo_rating": (low, high)})


def dq_feature_keys(store: DataFrame, table: str, key: Sequence[str] = KEY, columns: Sequence[str] = ("rodada", "clube_id")) -> DataFrame:
    return dq_unique(store, table, [*key, *columns])


def dq_status(runs: DataFrame, checks: DataFrame) -> DataFrame:
    """No check failed, and at least one run succeeded."""
    failed_checks = conditions(checks, "gold.data_quality_checks", {"sem_falha_critica": F.col("status") == "failed"})
    succeeded = F.count(F.when(F.col("status") == "success", 1))
    counts = runs.agg(
        F.count("*").alias("_n"), F.when(succeeded > 0, 0).otherwise(1).cast("bigint").alias("records_failed")
    )
    some_success = _report(counts.withColumn("check_name", F.lit("alguma_execucao_ok")), "gold.pipeline_executions", "failed")
    return union_reports(failed_checks, some_success)


def dq_predictions(predictions: DataFrame, table: str = "gold.previsoes_proximas_partidas") -> DataFrame:
    return dq_row_count(predictions, table, "inferencia_previsoes")


def payload_nonempty(df: DataFrame, column: str = "raw_payload") -> DataFrame:
    """Rows whose payload holds something."""
    return df.filter(F.length(column) > 0)


MIN_ACCURACY = 0.45


def accuracy_gate(metrics: DataFrame, minimum: float = MIN_ACCURACY) -> DataFrame:
    """One report row per metrics row; warning below the minimum accuracy."""
    good = F.col("acuracia") >= minimum
    return metrics.select(
        F.lit("modelo_acuracia_minima").alias("check_name"), F.lit("gold.modelos_registry").alias("tabela"),
        F.when(good, "success").otherwise("warning").alias("status"), F.lit(1).cast("bigint").alias("records_checked"),
        F.when(good, 0).otherwise(1).cast("bigint").alias("records_failed"),
        F.format_string("acuracia=%.4f", F.col("acuracia")).alias("detalhe"),
    )
