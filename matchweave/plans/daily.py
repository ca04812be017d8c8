"""The daily run: feeds to raw, clean, feature, prediction and published tables.

Each stage reads the tables of the one before and writes its own, so a stage can be
repeated alone. Every stage leaves an audit row and its quality checks.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchweave.operators import accuracy, clean, dataset, features, forest, joins, quality, standings
from matchweave.operators.latest import KEY, MATCH_KEY, append_dedupe
from matchweave import session
from matchweave.plans.marts import mart_predictions, standard_views
from matchweave.session import stage as staged
from matchweave.sources import audit, feeds, views
from matchweave.operators.rating_store import RatingStore
from matchweave.sources.tables import consume, read_version, replace_table, version_exists, write_if_nonempty

log = logging.getLogger("matchweave")

RUNS, CHECKS = "gold.pipeline_executions", "gold.data_quality_checks"


@dataclass
class Lake:
    """A folder of tables, one per name."""

    spark: SparkSession
    root: str
    key: Sequence[str] = KEY
    forest_options: dict = field(default_factory=dict)
    #: Days of a window of ratings.
    window: int = 7
    #: Check rows of the stage that runs, written together at its end; None outside of one, where each is written at once.
    reports: list[DataFrame] | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return version_exists(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        return read_version(self.spark, self.path(name))

    def consume(self, name: str, reader: str, work: Callable[[DataFrame], None]) -> None:
        """Hand ``work`` what ``reader`` has not seen of an append log."""
        consume(self.spark, self.path(name), self.path(f"{reader}.lido"), work)

    def replace(self, name: str, df: DataFrame, checks: quality.Observed | None = None, allow_empty: bool = False) -> int:
        """New version unless ``df`` is empty; ``df`` may read the table itself. ``checks`` are counted on the way."""
        clustered = self._clustered(df)
        count = replace_table(clustered if checks is None else checks.of(clustered), self.path(name), allow_empty=allow_empty)
        if checks is not None and (count or allow_empty):
            self.check(checks.report(self.read(name)))
        return count

    def ratings(self) -> RatingStore:
        return RatingStore(self.spark, self.path("gold.elo"), self.key, days=self.window)

    def _clustered(self, df: DataFrame) -> DataFrame:
        """Rows of a competition together, so that a read of one skips the other files.

        A rebalance, not a repartition: AQE cuts a competition that outgrows a task into
        several and merges the small ones, where a directory per competition would give
        either one huge file or many tiny ones.
        """
        if not set(self.key) <= set(df.columns):
            return df
        return df.hint("rebalance", *self.key).sortWithinPartitions(*self.key)

    @property
    def model_path(self) -> str:
        return self.path("modelo")

    def check(self, report: DataFrame) -> None:
        if self.reports is None:
            audit.log_check(report, self.path(CHECKS))
        else:
            self.reports.append(report)

    def flush(self) -> None:
        """Append all check rows gathered so far, in one write."""
        gathered, self.reports = self.reports, None
        if gathered:
            audit.log_check(quality.union_reports(*[r.select(*audit.CHECKS.names) for r in gathered]).coalesce(1), self.path(CHECKS))

    def check_count(self, name: str, table: str, count: int) -> None:
        status = "success" if count > 0 else "warning"
        row = [(name, table, status, count, 0, f"{count} registros")]
        self.check(self.spark.createDataFrame(row, audit.CHECKS))


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def run_stage(lake: Lake, name: str, work: Callable[[Lake], tuple[str, int, str | None]]) -> str:
    """Run ``work`` and write its audit row; a failure is recorded, then raised."""
    started, lake.reports = _now(), []
    try:
        try:
            status, records, reason = work(lake)
        finally:
            lake.flush()
    except Exception as error:
        audit.log_run(lake.spark, lake.path(RUNS), name, "failed", started, _now(), error=str(error)[:1000])
        raise
    audit.log_run(lake.spark, lake.path(RUNS), name, status, started, _now(), records=records, error=reason)
    return status


def bronze(lake: Lake, landed: dict[str, DataFrame]) -> tuple[str, int, str | None]:
    """``landed``: feeds ``partidas``, ``clubes``, ``atletas``, ``pontuacoes``, ``status``, any absent."""
    total = 0
    steps = [
        ("partidas", "bronze.partidas_raw", feeds.ingest_matches, "append"),
        ("clubes", "bronze.clubes_info_raw", feeds.ingest_clubs, "overwrite"),
        ("atletas", "bronze.jogadores_status_raw", feeds.ingest_athletes, "overwrite"),
    ]
    for feed, table, ingest, mode in steps:
        count = 0
        if feed in landed:
            batch = ingest(landed[feed]).withColumn("ingested_at", F.current_timestamp())
            count = write_if_nonempty(batch, lake.path(table), mode=mode)
        lake.check_count(f"bronze_{feed}_count", table, count)
        total += count
    if "pontuacoes" in landed:
        rounds = feeds.current_round(landed["status"]).agg(F.max("rodada_atual")) if "status" in landed else None
        current = 1 if rounds is None else rounds.first()[0]
        batch = feeds.ingest_scores(landed["pontuacoes"], current).withColumn("ingested_at", F.current_timestamp())
        total += write_if_nonempty(batch, lake.path("bronze.pontuacoes_historico_raw"), mode="append")
    return "success", total, None


def silver(lake: Lake) -> tuple[str, int, str | None]:
    """Clean tables. Rows already there survive a feed that no longer carries them."""
    total = 0
    if lake.exists("bronze.partidas_raw"):
        counts = []

        def merge(rows: DataFrame) -> None:
            new = clean.silver_matches(rows, lake.key, order=["ingested_at", "data_partida", "partida_id"])
            played = [*MATCH_KEY]
            classes = F.col("resultado").isNotNull()
            failing = {n: classes & c for n, c in quality.accepted("resultado", ["casa", "empate", "visitante"]).items()}
            checks = quality.Observed("silver.partidas", [("failed", quality.not_null(played) | failing)], [["partida_id"]])
            counts.append(_merge(lake, "silver.partidas", new, [*lake.key, *MATCH_KEY], checks))

        lake.consume("bronze.partidas_raw", "silver.partidas", merge)
        total += counts[-1] if counts else 0
    if lake.exists("bronze.clubes_info_raw"):
        clubs = clean.silver_clubs(lake.read("bronze.clubes_info_raw"), order=["ingested_at"])
        total += _merge(lake, "silver.clubes", clubs, ["clube_id"])
    if lake.exists("bronze.pontuacoes_historico_raw") and lake.exists("bronze.jogadores_status_raw"):
        scores, athletes = lake.read("bronze.pontuacoes_historico_raw"), lake.read("bronze.jogadores_status_raw")
        name = "silver.estatisticas_jogador_partida"
        count = lake.replace(name, clean.silver_player_scores(scores, athletes, dedupe=True), allow_empty=True)
        lake.check_count("silver_estatisticas_count", name, count)
        total += count
    return "success", total, None


def _merge(lake: Lake, name: str, new: DataFrame, keys: list[str], checks: quality.Observed | None = None) -> int:
    """Add ``new`` to the table, the row added last winning per key; the count is the table's."""
    merged = append_dedupe(lake.read(name), new, keys, []) if lake.exists(name) else new
    count = lake.replace(name, merged, checks)
    lake.check_count(f"{name.replace('.', '_')}_count", name, count)
    return count


def gold(lake: Lake) -> tuple[str, int, str | None]:
    """Feature stores: the published one, the model's, and the enhanced one."""
    if not lake.exists("silver.partidas"):
        return "skipped", 0, "silver.partidas vazia"
    matches = lake.read("silver.partidas")
    lake.ratings().update(matches)  # the one rating of the day, from the first match that changed
    rated = lake.ratings().rated()
    keys, Q = [[*lake.key, "rodada", "clube_id"]], quality
    sound = [("warning", Q.in_range("aproveitamento_pct", 0, 100)), ("failed", Q.bounds({"pontos_acumulados": (0, None)}))]
    tables = {
        "gold.feature_store": (features.feature_store(matches, lake.key, per_round=True), sound),
        "gold.feature_store_model": (features.feature_store(matches, lake.key, variant="job", per_round=True), []),
        "gold.feature_store_enhanced": (features.features_job(rated, lake.key, per_round=True, rated=True), [("failed", Q.bounds({"elo_rating": (1300, 1800)}))]),
    }
    total = 0
    for name, (df, rules) in tables.items():
        count = lake.replace(name, df, Q.Observed(name, rules, keys))
        lake.check_count(f"{name.replace('.', '_')}_count", name, count)
        total += count
    return "success", total, None


def train(lake: Lake) -> tuple[str, int, str | None]:
    matches = lake.read("silver.partidas")
    marked = lake.ratings().marked()
    state = features.model_state(lake.ratings().rated() if marked else matches, lake.key, rated=marked)
    rows = staged(dataset.training_rows(matches, state, lake.key), "treino")
    if not dataset.enough_rows(rows):
        return "skipped", 0, "Dados insuficientes"
    split = staged(dataset.time_split(rows), "treino_dividido")
    model = forest.train_forest(split.filter("conjunto = 'treino'"), **lake.forest_options)
    metrics = forest.model_metrics(model, split.filter("conjunto = 'teste'"))
    audit.save_model(model, lake.model_path)
    rounds = tuple(forest.split_rounds(split).first())[:2]
    params = forest.FOREST | lake.forest_options
    new = audit.new_model(lake.spark, "previsao_resultados", forest.ALGORITHM, metrics, rounds, params, _now())
    name = "gold.modelos_registry"
    lake.replace(name, audit.register_model(lake.read(name), new) if lake.exists(name) else new)
    lake.check(quality.accuracy_gate(new))
    return "success", rows.count(), None


def infer(lake: Lake) -> tuple[str, int, str | None]:
    """Validate the predictions of the last run, then predict what is ahead now."""
    if not audit.model_exists(lake.spark, lake.model_path):
        return "skipped", 0, "Modelo nao encontrado"
    matches = lake.read("silver.partidas")
    clubs = lake.read("silver.clubes")
    ahead_name = "gold.previsoes_proximas_partidas"
    total = 0
    if lake.exists(ahead_name):
        joined = joins.join_prediction_result(lake.read(ahead_name), matches, lake.key)
        total += lake.replace("gold.previsoes_validadas", accuracy.validate_predictions(joined, lake.key))
    version = audit.active_version(lake.read("gold.modelos_registry")).first()[0]
    fixtures = clean.upcoming(matches).select(*lake.key, "partida_id", *MATCH_KEY)
    with_state = joins.features_ahead(fixtures, features.model_state(lake.ratings().rated(), lake.key, ahead=True, rated=True), lake.key)
    named = joins.join_club_names(with_state, clubs)
    predicted = forest.predict(audit.load_model(lake.model_path), named, version, lake.key)
    predicted = predicted.withColumnRenamed("partida_id", "id").withColumn("processed_at", F.lit(_now()))
    count = lake.replace(ahead_name, predicted, quality.Observed(ahead_name, [("failed", quality.prob_sum())]))
    lake.check_count("inferencia_previsoes", ahead_name, count)
    risk = standings.relegation_risk(lake.read("gold.feature_store"), clubs, lake.key)
    name = "gold.analise_rebaixamento"
    checks = quality.Observed(name, [("failed", quality.bounds({"prob_rebaixamento": (0, 1)}))])
    return "success", total + count + lake.replace(name, risk, checks, allow_empty=True), None


def publish(lake: Lake) -> tuple[str, int, str | None]:
    clubs, store = lake.read("silver.clubes"), lake.read("gold.feature_store")
    total = 0
    if lake.exists("gold.analise_rebaixamento"):
        risk = lake.read("gold.analise_rebaixamento")
        total += lake.replace("gold.mart_tabela_classificacao", standings.mart_standings(store, clubs, risk, lake.key), allow_empty=True)
    if lake.exists("gold.previsoes_proximas_partidas"):
        ahead, enhanced = lake.read("gold.previsoes_proximas_partidas"), lake.read("gold.feature_store_enhanced")
        total += lake.replace("gold.mart_previsoes_proximas", mart_predictions(ahead, clubs, store, enhanced, lake.key), allow_empty=True)
    if lake.exists("gold.previsoes_validadas"):
        performance = accuracy.mart_performance(lake.read("gold.previsoes_validadas"), lake.key)
        total += lake.replace("gold.mart_desempenho_modelo", performance, allow_empty=True)
    _views(lake, store, clubs)
    places = quality.dq_positions(lake.spark.table("gold_vw_classificacao"), lake.key)
    lake.check(quality.conditions(places, "gold.vw_classificacao", {"posicoes_sequenciais": F.col("status") == "failed"}))
    return "success", total, None


def _views(lake: Lake, store: DataFrame, clubs: DataFrame) -> None:
    """The standard views, of those tables that there are."""
    none = {
        "gold.previsoes_proximas_partidas": "nome_casa string, nome_vis string, prob_casa double, prob_empate double, prob_visitante double, "
        "previsao string, confianca double, modelo_versao string, processed_at timestamp_ntz",
        "gold.previsoes_validadas": "previsao string, resultado_real string, acerto boolean, prob_casa double, prob_empate double, prob_visitante double",
    }
    keys = ", ".join([*(f"{c} {dict(store.dtypes)[c]}" for c in lake.key), "rodada int"])
    tables = [lake.read(n) if lake.exists(n) else lake.spark.createDataFrame([], f"{keys}, {columns}") for n, columns in none.items()]
    views.register_views(standard_views(store, clubs, *tables, lake.key))


def run_day(lake: Lake, landed: dict[str, DataFrame]) -> dict[str, str]:
    """All stages in order; the status of each."""
    stages = {
        "bronze": lambda l: bronze(l, landed), "silver": silver, "gold": gold,
        "gold_ml_training": train, "gold_ml_inference": infer, "gold_marts": publish,
    }
    mark = session.scratch_mark()
    try:
        return {name: run_stage(lake, name, work) for name, work in stages.items()}
    finally:
        session.clear_scratch(lake.spark, mark)
