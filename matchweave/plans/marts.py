"""Published prediction mart and the standard views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from matchweave.functions.numeric import half_up, pct
from matchweave.operators.accuracy import accuracy_view
from matchweave.operators.joins import join_latest_six
from matchweave.operators.latest import KEY, latest_per_key
from matchweave.operators.reads import predictions_view
from matchweave.operators.standings import latest_state, view_ranking, view_standings


def mart_predictions(
    predictions: DataFrame, clubs: DataFrame, store: DataFrame, enhanced: DataFrame, key: Sequence[str] = KEY
) -> DataFrame:
    """Upcoming predictions with names, crests, latest standing and rating of both clubs."""
    ratings = latest_per_key(enhanced.select(*key, "clube_id", "rodada", "elo_rating"), [*key, "clube_id"], ["rodada"])
    wide = join_latest_six(predictions, clubs, latest_state(store, key), ratings, key)
    whole = {"elo_casa": "elo_rating_casa", "elo_visitante": "elo_rating_vis"}
    return wide.select(
        *key, "id", "rodada", "clube_casa_id", "clube_vis_id",
        F.coalesce("nome_casa", "clube_nome_casa").alias("nome_casa"),
        F.coalesce("nome_vis", "clube_nome_vis").alias("nome_visitante"),
        F.col("abreviacao_casa").alias("abrev_casa"), F.col("abreviacao_vis").alias("abrev_visitante"),
        F.col("escudo_url_casa").alias("escudo_casa"), F.col("escudo_url_vis").alias("escudo_visitante"),
        *[pct(F.col(f"prob_{c}")).alias(f"prob_{c}_pct") for c in ("casa", "empate", "visitante")],
        "previsao", pct(F.col("confianca")).alias("confianca_pct"), "modelo_versao",
        *[half_up(F.col(c), 0).alias(n) for n, c in whole.items()],
        F.col("pontos_acumulados_casa").alias("pontos_casa"), F.col("pontos_acumulados_vis").alias("pontos_visitante"),
        F.col("aproveitamento_pct_casa").alias("aprov_casa_pct"), F.col("aproveitamento_pct_vis").alias("aprov_vis_pct"),
        "processed_at",
    )


def standard_views(
    store: DataFrame, clubs: DataFrame, predictions: DataFrame, validated: DataFrame, key: Sequence[str] = KEY
) -> dict[str, DataFrame]:
    """The four views, by the name they are published under."""
    return {
        "vw_classificacao": view_standings(store, clubs, key),
        "vw_elo_ranking": view_ranking(store, clubs, key),
        "vw_previsoes": predictions_view(predictions, key),
        "vw_desempenho_modelo": accuracy_view(validated, key),
    }
