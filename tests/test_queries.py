"""Every query against its SQL on whole tables, and what its plan must not hold."""

import pytest

import __spark_entry__ as contract
from oracle_check import connect, differences
from tallyworks.plans import catalog, oracles

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, oracles.ORACLES
# sampling and the filters with false positives have no SQL
ROWS_ONLY = {"sample_percent", "bloom_token_filter_raw"}


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_oracles_cover_the_queries():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    result = QUERIES[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    if name in ORACLES:
        assert differences(result, db, ORACLES[name]) == ""
    else:
        assert result.count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 10


def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["grep", "contains", "threshold", "not_category"])
def test_filters_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(spark, name)


def test_threshold_reaches_the_scan(spark):
    assert "GreaterThanOrEqual(c_acctbal,1500.0)" in plan_of(spark, "threshold")


def test_scan_reads_needed_columns_only(spark):
    assert "ReadSchema: struct<user_id:bigint>" in plan_of(spark, "unique_user_count")
    assert "ReadSchema: struct<text:string>" in plan_of(spark, "word_count")


def test_counts_use_partial_aggregation(spark):
    assert "partial_count" in plan_of(spark, "word_count")


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "top10_records")


def test_no_step_of_the_sample_has_a_fixed_number_of_tasks(spark):
    plan = QUERIES["sample_repeatable"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 3" not in plan and "RepartitionByExpression [l_orderkey" in plan


def test_documents_are_read_before_the_flags_are_counted(spark):
    result = QUERIES["bloom_token_flags"](spark, SF_DIR)
    assert not [f for f in result.inputFiles() if "/documents.parquet" in f]
