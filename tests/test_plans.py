"""Physical-plan properties the operators rely on at scale."""

import pytest

from conftest import SF
from kestrel.plans import shop


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def small_bcast(spark):
    # keep Spark from broadcasting the tiny test tables on its own, so the
    # plans show the choices the operators make themselves
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # untruncated scan details
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_rule_match_broadcasts_rules_and_prunes_columns(spark, small_bcast):
    p = plan(shop.rule_match_inner(spark, SF))
    assert "BroadcastHashJoin" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in p


def test_few_ranges_are_a_case_chain(spark, small_bcast):
    p = plan(shop.consume_cycle(spark, SF))
    assert "CASE WHEN" in p and "Join" not in p


def test_top1_limits_before_shuffle(spark, small_bcast):
    p = plan(shop.top1_window(spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_most_frequent_needs_no_window(spark, small_bcast):
    p = plan(shop.pay_type_top1(spark, SF))
    assert "Window" not in p and "partial_min" in p


def test_measures_aggregate_partially(spark, small_bcast):
    p = plan(shop.rfm_measures(spark, SF))
    assert "partial_max" in p and "partial_count" in p and "partial_sum" in p
    assert "o_orderstatus" not in p  # unused columns never read


def test_condition_string_reaches_parquet(spark, small_bcast):
    p = plan(shop.condition_filter(spark, SF))
    assert "PushedFilters" in p and "EqualTo(o_orderstatus,F)" in p


def test_export_is_range_partitioned(spark, small_bcast):
    p = plan(shop.to_cells(spark, SF))
    assert "rangepartitioning(row_key" in p


def test_no_python_udf_in_sql_checked_queries(spark, small_bcast):
    from kestrel.plans.registry import SQL_CHECKED
    for name in SQL_CHECKED:
        p = plan(getattr(shop, name)(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "CartesianProduct" not in p, name


def test_relative_window_reaches_parquet(spark, small_bcast):
    p = plan(shop.relative_date_filter(spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,2001-02-03T00:00)" in p and "LessThan(o_orderdate,2001-08-02T00:00)" in p
