"""Published views and their aliases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ALIASED = (
    "previsoes_proximas_partidas", "previsoes_validadas", "analise_rebaixamento",
    "modelos_registry", "pipeline_executions", "data_quality_checks",
)


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Make each table readable by SQL as ``gold_<name>``; legacy names get ``diamond_<name>``."""
    names = []
    for name, df in tables.items():
        schemas = ("gold", "diamond") if name in ALIASED else ("gold",)
        for schema in schemas:
            view = f"{schema}_{name}"
            df.createOrReplaceTempView(view)
            names.append(view)
    return names


def read_view(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
