"""Plans: one exchange per feature table, pushed filters, pruned columns."""

import os
import re

import pytest

from matchweave.catalog import layers
from matchweave.operators import clubrows as C, features, joins
from matchweave.sources.league_from_orders import raw_matches

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("build", [features.feature_store, features.features_sql, lambda m: features.feature_store(m, variant="job")])
def test_a_feature_table_costs_one_exchange_and_one_sort(spark, build):
    text = plan(build(layers.matches(spark, SF_DIR)))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert len(re.findall(r"\bSort \[", text)) == 1
    assert "PushedFilters: [IsNotNull(resultado)]" in text


def test_raw_matches_scan_only_what_they_need(spark):
    text = plan(raw_matches(spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double>" in text
    assert text.count("lineitem.parquet") == 1
    assert "Window" not in text
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", text)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 2  # lineitem, and orders unless they are broadcast


@pytest.mark.parametrize("build", [C.form5_prior, C.venue_rate_prior, C.momentum_sum3, C.cum_stats, C.goal_diff_double])
def test_windows_run_no_job_before_the_query(spark, build):
    rows = C.club_rows(layers.matches(spark, SF_DIR))
    spark.sparkContext.setJobGroup("windows", "windows")
    text = plan(C.over_clubs(rows, build(), ["clube_id", "partida_id"]))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("windows")
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_asof_has_no_range_join(spark):
    matches = layers.matches(spark, SF_DIR)
    state = joins.join_features(layers.enhanced_sql(spark, SF_DIR), layers.store(spark, SF_DIR))
    text = plan(joins.features_asof(matches, state))
    assert "rodada" in text and " < " not in text and " > " not in text
