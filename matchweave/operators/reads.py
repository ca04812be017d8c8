"""Read queries of the API, the BI charts and the client screens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from matchweave.functions.numeric import half_up
from matchweave.operators.latest import KEY, latest_per_key


def top_predictions(mart: DataFrame) -> DataFrame:
    return mart.orderBy("rodada", F.desc("prob_casa_pct"))


def top_standings(mart: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return mart.orderBy(*key, "posicao")


def top_ranking(view: DataFrame, n: int = 30, key: Sequence[str] = KEY) -> DataFrame:
    """First ``n`` places; the ranks already exist, so no sort per competition."""
    return view.filter(F.col("ranking") <= n).orderBy(*key, "ranking")


def performance_by_round(mart: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return mart.orderBy(*key, "rodada")


def latest_models(registry: DataFrame, n: int = 10) -> DataFrame:
    return registry.orderBy(F.desc("processed_at"), F.desc("versao")).limit(n)


def latest_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)


def relegation_sorted(mart: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return mart.select(
        *key, "posicao", "clube", "abreviacao", "escudo_url", "pontos", "jogos",
        "prob_rebaixamento_pct", "zona_rebaixamento", "cor_situacao",
    ).orderBy(F.desc_nulls_last("prob_rebaixamento_pct"))


def predictions_view(predictions: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return predictions.select(
        *key, "rodada", "nome_casa", "nome_vis", "prob_casa", "prob_empate", "prob_visitante",
        "previsao", "confianca", "modelo_versao", "processed_at",
    ).orderBy("rodada", F.desc("confianca"))


def best_round(perf: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Highest accuracy, the latest round on ties."""
    best = F.max(F.struct("acuracia_pct", "rodada")).alias("_best")
    return perf.groupBy(*key).agg(best).select(*key, "_best.rodada", "_best.acuracia_pct")


CLASS_COLUMNS = ("acuracia_casa_pct", "acuracia_empate_pct", "acuracia_visitante_pct")


def latest_round_row(perf: DataFrame, key: Sequence[str] = KEY, with_class: bool = False) -> DataFrame:
    """The last round's row, or the last that has any accuracy by class."""
    known = perf.filter(F.coalesce(*CLASS_COLUMNS).isNotNull()) if with_class else perf
    return latest_per_key(known, list(key), ["rodada"])


def latest_rounds(perf: DataFrame, key: Sequence[str] = KEY, n: int = 10) -> DataFrame:
    """Last ``n`` rounds, newest first, marked with the roles the screen gives them.

    A round's row number counts rows of the performance mart, one per round.
    """
    newest = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("rodada")))
    typed = latest_round_row(perf, key, with_class=True).select(*key, F.col("rodada").alias("_tipo"))
    recent = perf.withColumn("ordem", newest).filter(F.col("ordem") <= n).join(typed, list(key), "left")
    return recent.select(
        *key, "ordem", "rodada", "total_jogos", "acertos", "acuracia_pct", "acuracia_media_5r",
        F.coalesce(F.col("rodada") == F.col("_tipo"), F.lit(False)).alias("ultima_com_classe"),
    ).orderBy(*key, "ordem")


def confidence_gap(perf: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Mean hit confidence less mean miss confidence in the last round."""
    gap = half_up(F.col("conf_media_acerto") - F.col("conf_media_erro"), 1)
    return latest_round_row(perf, key).select(*key, "rodada", gap.alias("diferenca"))


def bi_table(df: DataFrame, columns: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """Raw chart: chosen columns, one order, a row limit. Planned as a top-n, not a sort."""
    return df.orderBy(*order).select(*columns).limit(n)


def bi_max_topn(df: DataFrame, labels: Sequence[str], column: str, n: int, name: str = "valor") -> DataFrame:
    """MAX of a column by label, greatest first; the label breaks ties."""
    return df.groupBy(*labels).agg(F.max(column).alias(name)).orderBy(F.desc(name), *labels).limit(n)


def bi_count_by(df: DataFrame, labels: Sequence[str], counted: str = "*", name: str = "quantidade") -> DataFrame:
    return df.groupBy(*labels).agg(F.count(counted).alias(name)).orderBy(F.desc(name), *labels)


def distinct_clubs(df: DataFrame, column: str = "clube_id") -> DataFrame:
    return df.agg(F.countDistinct(column).alias("clubes"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("registros")).select(F.lit(n).alias("tabela"), "registros") for n, df in tables.items()]
    report = counts[0]
    for part in counts[1:]:
        report = report.unionByName(part)
    return report


def kpi_summary(perf: DataFrame, predictions: DataFrame, registry: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Headline numbers per competition; the newest model is the same for all.

    Both facts are reduced to one row per competition before they meet, and the model
    enters as scalar subqueries.
    """
    newest = {
        "acuracia_geral": "acuracia_geral_pct",
        "total_previsoes_historico": "total_jogos_acumulado",
        "acertos_historico": "acertos_acumulado",
    }
    latest = perf.groupBy(*key).agg(*[F.max_by(c, "rodada").alias(n) for n, c in newest.items()])
    ahead = predictions.groupBy(*key).agg(F.count("*").alias("proximas_partidas"))
    model = F.max_by(F.struct("modelo_nome", "acuracia"), F.struct("processed_at", "versao"))
    return latest.join(ahead, list(key), "full").select(
        *key, *newest, F.coalesce("proximas_partidas", F.lit(0)).alias("proximas_partidas"),
        registry.agg(model.alias("m")).select("m.modelo_nome").scalar().alias("melhor_modelo"),
        registry.agg(model.alias("m")).select("m.acuracia").scalar().alias("acuracia_modelo"),
    )
