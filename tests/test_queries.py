"""Registered queries against their SQL, and what their plans must not contain."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from versemill.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.QUERIES, oracle.sql()
BUILT_IN_ONLY = (
    "rename_filter_language normalise_and_map_labels clean_genius clean_multilingual drop_nulls stage_audit "
    "union_sources union_dedup_first class_counts class_rank balance_bootstrap stratified_split sample_n "
    "harmonize word_ngrams tfidf_vocabulary tfidf_vectors encode_fixed_length"
).split()


@pytest.fixture(scope="module")
def database():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, database, name):
    assert difference(QUERIES[name](spark, SF), database, SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", BUILT_IN_ONLY)
def test_plan_stays_in_the_jvm_without_cross_products(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_neighbor_plan_limits_each_query_before_the_shuffle(spark):
    plan = QUERIES["knn_cosine"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_class_sample_limits_before_the_shuffle(spark):
    plan = QUERIES["class_sample"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["class_counts", "min_class_count", "distinct_labels"])
def test_counting_classes_shuffles_no_text(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert aggregates and not any("text, " in line.split("min_by(")[-1].split(")")[0] for line in aggregates)
