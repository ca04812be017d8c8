"""Tables that several queries read: built once per session and test-data folder.

The clean matches and the feature stores are published tables of the league, written by
one step and read by the next. The first query that needs one builds and writes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from matchweave.operators import dataset, features, forest, joins, standings
from matchweave.session import shared_folder, stage
from matchweave.sources import audit, league_from_orders as league

_built: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _built:
        _built[slot] = build()
    return _built[slot]


def forget() -> None:
    """Drop the memory of what was built, so that the next query builds it again."""
    _built.clear()


def _table(name: str, build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def get(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _once(spark, sf_dir, name, lambda: stage(build(spark, sf_dir), name))

    return get


raw = _table("partidas_raw", league.raw_matches)
matches = _table("partidas", lambda s, d: league.matches(raw(s, d)))
predictions = _table("previsoes", lambda s, d: league.predictions_of(matches(s, d)))
store = _table("feature_store", lambda s, d: features.feature_store(matches(s, d)))
store_job = _table("feature_store_job", lambda s, d: features.feature_store(matches(s, d), variant="job"))
enhanced_job = _table("feature_store_enhanced", lambda s, d: features.features_job(matches(s, d)))
enhanced_sql = _table("feature_store_sql", lambda s, d: features.features_sql(matches(s, d)))
latest = _table("estado_atual", lambda s, d: standings.latest_state(store(s, d)))
current = _table("ultima_rodada", lambda s, d: joins.join_latest_round(store(s, d)))
risk = _table("analise_rebaixamento", lambda s, d: standings.relegation_risk(current(s, d), league.clubs(s, d)))
training = _table("treino", lambda s, d: dataset.training_rows(matches(s, d), features.model_state(matches(s, d))))
split = _table("treino_dividido", lambda s, d: dataset.time_split(training(s, d)))


def model_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the model trained on the first part of the split."""
    def build() -> str:
        path = f"{shared_folder(spark)}/modelo-{abs(hash((spark.sparkContext.applicationId, sf_dir)))}"
        model = forest.train_forest(split(spark, sf_dir).filter("conjunto = 'treino'"))
        audit.save_model(model, path)
        return path

    return _once(spark, sf_dir, "modelo", build)


def model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return audit.load_model(model_path(spark, sf_dir))
