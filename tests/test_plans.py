"""Plan shape: no products of tables, no Python nodes, pruned scans, no single-task windows over rows."""

import re

import pytest

from granero.suite import QUERIES, run

# Counting, writing and reading back happen while these are built, so their plans are checked in parts.
FORBIDDEN = ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "MapInPandas", "FlatMapGroups")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if "stream" not in n))
def test_no_forbidden_nodes(spark, folder, name):
    text = _plan(run(QUERIES[name], spark, folder))
    found = [node for node in FORBIDDEN if node in text]
    assert not found, text[:3000]


def test_filters_and_columns_reach_the_scan(spark, folder):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = _plan(run(QUERIES["s01_scan_where"], spark, folder))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(l_quantity,45\.0\).*EqualTo\(l_returnflag,R\)", text)
    assert "l_comment" not in text and "l_tax" not in text


def test_top_k_limits_groups_before_the_shuffle(spark, folder):
    text = _plan(run(QUERIES["o02_top_k"], spark, folder))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_global_limit_is_a_top_k(spark, folder):
    assert "TakeOrderedAndProject" in _plan(run(QUERIES["o04_global_limit"], spark, folder))


def test_interval_join_hashes_on_its_key(spark, folder):
    text = _plan(run(QUERIES["j12_validity"], spark, folder))
    assert "HashJoin" in text or "SortMergeJoin" in text


def test_a_hot_join_key_is_split_even_before_an_aggregate(spark, folder):
    """One product holds a third of the sales; its partition must be read by several tasks."""
    from pyspark.sql import functions as F

    from granero.suite.registry import frame

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        sales = frame(spark, folder, "sales").repartition(8).withColumn("sku", F.expr("CASE WHEN order_id % 3 = 0 THEN 1 ELSE sku END"))
        joined = sales.join(frame(spark, folder, "skus").select("sku", "brand"), "sku").groupBy("sku", "brand").agg(F.sum("net"))
        joined.collect()
        assert "skew=true" in _plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
