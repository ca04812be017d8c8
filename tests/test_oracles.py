"""Every query against its SQL twin on the smallest test data."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, duck, run_sql
from matchweave.catalog import layers
from matchweave.operators import clean, features, forest, joins as J

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module", autouse=True)
def small_forest():
    full = dict(forest.FOREST)
    forest.FOREST.update(numTrees=5, maxDepth=4)
    yield
    forest.FOREST.update(full)


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    rows = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    assert rows
    if name in ORACLES:
        assert compare(df, rows, *run_sql(connection, ORACLES[name])) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    table = entry.entry(spark)
    assert {"competicao", "posicao", "nome", "pontos"} <= set(table.columns)
    assert table.count() > 0


def test_predictions_are_distributions(spark):
    fixtures = J.features_ahead(clean.upcoming(layers.matches(spark, SF_DIR)), features.model_state(layers.matches(spark, SF_DIR), ahead=True))
    rows = forest.score(layers.model(spark, SF_DIR), fixtures).collect()
    assert rows
    for row in rows:
        probs = {"casa": row.prob_casa, "empate": row.prob_empate, "visitante": row.prob_visitante}
        assert abs(sum(probs.values()) - 1) < 1e-9
        assert probs[row.previsao] == row.confianca == max(probs.values())
