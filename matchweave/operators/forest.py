"""Fit, evaluate and apply the random forest, all on MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from matchweave.operators import trees
from matchweave.operators.accuracy import CLASSES
from matchweave.operators.dataset import class_weights
from matchweave.operators.joins import FEATURES
from matchweave.operators.latest import KEY
from matchweave.session import stage

LABEL = "resultado"

# The published forest. MLlib bounds leaves, not splits, so the minimum
# split of 10 rows becomes a minimum of 5 rows per leaf.
FOREST = {"numTrees": 200, "maxDepth": 8, "minInstancesPerNode": 5, "seed": 42}
ALGORITHM = "RandomForestClassifier"
#: Memory that a task counts nodes in at once, which the forest does not depend on but for its random draws: what
#: stays in a core's cache is counted faster than MLlib's 256 MB, and a task holds less.
WORKING = {"maxMemoryInMB": 4}
#: Training rows of a file of blocks beyond one for each core. Each task sends counts of every node of every tree, whatever its
#: rows, so many small tasks cost more than the rows.
TASK_ROWS = 500_000


def tasks(train: DataFrame) -> int:
    """One for each core, more only from ``TASK_ROWS`` rows each on."""
    return max(train.sparkSession.sparkContext.defaultParallelism, -(-train.count() // TASK_ROWS))


def spread(train: DataFrame) -> DataFrame:
    """``train`` in equal tasks."""
    return train.repartition(tasks(train))


def train_forest(train: DataFrame, **options) -> PipelineModel:
    """Alphabetical labels, standardised features, balanced forest. ``train`` is read several times; pass a written table.

    The forest is grown by ``trees.grown``; settings that it does not know are left to MLlib's own training.
    """
    weights = class_weights(train, LABEL).select(LABEL, "peso")  # one row per class
    indexer = StringIndexer(inputCol=LABEL, outputCol="label", stringOrderType="alphabetAsc")
    first = Pipeline(stages=[
        indexer,
        VectorAssembler(inputCols=FEATURES, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ])
    forest = RandomForestClassifier(weightCol="peso", **(FOREST | WORKING | options))
    rows = train.select(LABEL, *FEATURES).where(F.col(LABEL).isNotNull())
    prepared = first.fit(rows)
    known = list(prepared.stages[0].labels)
    if trees.can_grow(forest, len(known)):
        by_class = {r[LABEL]: r["peso"] for r in weights.collect()}
        cores = train.sparkSession.sparkContext.defaultParallelism
        grown = trees.grown(prepared.transform(rows), forest, [by_class[c] for c in known], -(-tasks(rows) // cores) * cores)  # as many for each core
    else:
        grown = forest.fit(prepared.transform(spread(rows).join(F.broadcast(weights), LABEL)))
    return PipelineModel([*prepared.stages, grown])


def labels(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Append probabilities per class, the predicted class and its probability.

    Skips the label stage, since upcoming matches have no label. A class the model never
    saw has probability 0.
    """
    scored = rows
    for stage in model.stages[1:]:
        scored = stage.transform(scored)
    known = labels(model)
    scored = scored.withColumn("_p", vector_to_array("probability"))
    by_class = {c: F.col("_p")[known.index(c)] if c in known else F.lit(0.0) for c in CLASSES}
    best = F.array_max("_p")
    named = F.element_at(F.array(*map(F.lit, known)), F.array_position("_p", best).cast("int"))
    return scored.select(
        *rows.columns, *[p.alias(f"prob_{c}") for c, p in by_class.items()],
        named.alias("previsao"), best.alias("confianca"),
    )


def model_metrics(model: PipelineModel, test: DataFrame) -> dict[str, float]:
    """Accuracy, weighted F1 and log loss on ``test``, which is scored once."""
    scored = stage(model.transform(test).select("label", "prediction", "probability"), "avaliadas")
    names = {"acuracia": "accuracy", "f1_score": "f1", "log_loss": "logLoss"}
    return {
        name: MulticlassClassificationEvaluator(metricName=metric, labelCol="label").evaluate(scored)
        for name, metric in names.items()
    }


def split_rounds(split: DataFrame) -> DataFrame:
    """Last round of the training and of the test part and their sizes, in one row."""
    parts = ("treino", "teste")
    return split.agg(
        *[F.max(F.when(F.col("conjunto") == part, F.col("rodada"))).alias(f"rodada_{part}") for part in parts],
        *[F.count(F.when(F.col("conjunto") == part, 1)).alias(f"linhas_{part}") for part in parts],
    )


def predict(model: PipelineModel, fixtures: DataFrame, version: str, key: Sequence[str] = KEY) -> DataFrame:
    """Published predictions of fixtures that carry features and club names."""
    name = {s: F.coalesce(f"nome_{s}", F.col(f"clube_{s}_id").cast("string")).alias(f"nome_{s}") for s in ("casa", "vis")}
    return score(model, fixtures).select(
        *key, "partida_id", "rodada", "clube_casa_id", "clube_vis_id", name["casa"], name["vis"],
        *[f"prob_{c}" for c in CLASSES], "previsao", "confianca", F.lit(version).alias("modelo_versao"),
    )
