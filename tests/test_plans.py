"""Plan properties of the registered queries and operators."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from martkit.operators.clean import dedup_keep_first
from martkit.operators.raw import build_raw
from martkit.plans.inspect import forbidden_operators, operators, plan_text, scans
from martkit.sources import fixtures
from martkit.sources.tables import read_table

MODEL_KEYS = {"gbt_evaluate", "end_to_end_report"}


@pytest.mark.parametrize("key", sorted(set(E.queries()) - MODEL_KEYS))
def test_no_cartesian_nested_loop_or_python_eval(spark, sf001, key):
    df = E.queries()[key](spark, sf001)
    assert forbidden_operators(df) == []


def test_raw_mart_scans_are_pruned_and_pushed(spark, sf001):
    raw = E.queries()["raw_mart"](spark, sf001)
    sc = {s["Location"].split("/")[-1].rstrip("]"): s for s in scans(raw)}
    orders, customer = sc["orders.parquet"], sc["customer.parquet"]
    assert orders["ReadSchema"] == "struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>"
    assert "IsNotNull(o_custkey)" in orders["PushedFilters"]
    assert "IsNotNull(c_custkey)" in customer["PushedFilters"]
    assert "c_name" not in customer["ReadSchema"]


def test_filter_reaches_parquet(spark, sf001):
    li = read_table(spark, sf001, "lineitem").where(F.col("l_quantity") > 10).select("l_orderkey")
    (s,) = scans(li)
    assert "GreaterThan(l_quantity,10.0)" in s["PushedFilters"]
    assert s["ReadSchema"] == "struct<l_orderkey:bigint,l_quantity:double>"


def test_clean_mart_final_stage_is_one_codegen_span(spark, sf001):
    df = E.entry(spark)
    ops = operators(df)
    # a columnar scan of the staged mart: no join, no subquery, no row-format checkpoint
    assert set(ops) <= {"Project", "Filter", "ColumnarToRow", "Scan", "AdaptiveSparkPlan"}, ops
    assert len(scans(df)) == 1 and "ExistingRDD" not in plan_text(df)


def test_dedup_combines_before_the_shuffle(spark, sf001):
    li = read_table(spark, sf001, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    text = plan_text(dedup_keep_first(li, ["l_orderkey", "l_linenumber"], ["l_partkey"]))
    assert "partial_min" in text


def test_hot_building_is_split_by_skew_join(spark, sf001):
    # a third of all flats in one building; broadcast off so the skew path is taken
    # (AQE splits a skewed partition along map tasks; one small file is one map task,
    # so the input is spread over 8 tasks first, as many files would be at scale)
    flats = fixtures.flats(spark, sf001).repartition(8).withColumn(
        "building_id", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("building_id"))
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        raw = build_raw(flats, fixtures.buildings(spark, sf001))
        assert len(raw.collect()) == 1500
        final = plan_text(raw)  # after execution: AQE's final plan
        assert "isFinalPlan=true" in final
        assert "SortMergeJoin" in final and "skew=true" in final.replace(" ", "")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
