"""Work per task and files per key on growing input."""

import os
import re
import time

from pyspark.sql import functions as F

from granero.operators import ranking
from granero.session import cut_lineage, shared_folder, size_shuffles
from granero.suite import QUERIES, run


def test_shuffles_start_with_partitions_in_proportion_to_the_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    sizes = []
    for number, megabytes in enumerate((1, 100, 1000)):
        path = tmp_path / f"{number}.parquet"
        with open(path, "wb") as file:
            file.truncate(megabytes << 20)
        sizes.append(size_shuffles(spark, [str(path)]))
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == str(sizes[-1])
    assert sizes == [int(before), 25, 250]


def test_tasks_take_small_shares_of_files_and_shuffles(spark, folder):
    run(QUERIES["d76_unify_group_stock"], spark, folder)
    configured = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    assert [int(value.removesuffix("MB")) <= 32 for value in configured.values()] == [True, True]


def test_store_files_are_one_a_store_however_many_tasks_write(spark, folder, monkeypatch):
    from granero.suite import files

    path = f"{shared_folder(spark)}/store-files-{os.getpid()}"
    monkeypatch.setattr(files, "_folder", lambda df: path)
    rows = run(QUERIES["s06_store_files"], spark, folder)
    stores = rows.select("store_id").distinct().count()
    written = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(path).select("path").count()
    assert stores > 1 and written == stores


def test_store_ranking_deals_every_shuffle_in_proportion_to_the_input(spark, folder, monkeypatch):
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df)

    size = os.path.getsize(f"{folder}/lineitem.parquet")
    monkeypatch.setattr("granero.session.SHUFFLE_SHARE", size // 40)
    monkeypatch.setattr(ranking, "cut_lineage", noted)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(initial, None)
    try:
        run(QUERIES["d08_store_ranking"], spark, folder)
    finally:
        spark.conf.unset(initial) if before is None else spark.conf.set(initial, before)
    shuffles = re.findall(r"Exchange \w+partitioning\(.*, (\d+)\), ", "\n".join(plans))
    # Of the totals, the distinct values of three measures and their sort, and the sort by store and score.
    assert len(plans) == 3 and len(shuffles) >= 6
    assert set(shuffles) == {str(-(-size // (size // 40)))}


UNJOINED = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}


def test_positions_in_one_hot_group_are_numbered_by_many_tasks(spark):
    before = {key: spark.conf.get(key) for key in UNJOINED}
    try:
        for key, value in UNJOINED.items():
            spark.conf.set(key, value)
        df = spark.range(8000).select((F.col("id") % 2000 == 0).alias("g"), F.col("id").alias("v"))
        got = ranking.positions(df, [F.col("v").asc()], "p", ["g"])
        tasks = got.groupBy(F.spark_partition_id()).count().collect()
        assert max(row["count"] for row in tasks) < 2000 and sum(row["count"] for row in tasks) == 8000
        assert got.where("NOT g AND p <> v - ceil(v / 2000) + 1 OR g AND p <> v / 2000 + 1").isEmpty()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_distinct_values_of_a_measure_do_not_meet_in_one_task(spark):
    before = {key: spark.conf.get(key) for key in UNJOINED}
    try:
        for key, value in UNJOINED.items():
            spark.conf.set(key, value)
        df = cut_lineage(spark.range(8000).select("id", (F.col("id") % 2).alias("few"), F.expr("nullif(id, 7)").alias("many")))
        ranks = ranking.dense_ranks(df, {"few_rank": "few", "many_rank": "many"}, broadcast_values=0)
        assert "_column" not in "".join(re.findall(r"hashpartitioning\(.*", ranks._jdf.queryExecution().executedPlan().toString()))
        assert ranks.where("few_rank <> 2 - few OR many_rank <> CASE WHEN id = 7 THEN 1 WHEN id > 7 THEN 8001 - id ELSE 8000 - id END").isEmpty()
        assert ranks.count() == 8000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for folder in folders for _, _, names in os.walk(folder.getPath()) for name in names if name.startswith("shuffle_")}


def test_what_a_table_shuffled_is_gone_once_it_is_written(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, found = spark.conf.get(setting, None), _shuffle_files(spark)
    saved = cut_lineage(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count())
    for _ in range(100):  # files are removed in the background
        if _shuffle_files(spark) <= found:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= found and spark.conf.get(setting, None) == before
    assert saved.count() == 100 and saved.agg(F.sum("count")).first()[0] == 10_000


def _shuffles_of(spark, folder, name):
    """Hash shuffles of the last step of a query whose joins are not broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = run(QUERIES[name], spark, folder)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return re.findall(r"Exchange hashpartitioning\((\w+)#", plan)


def test_late_funding_shuffles_open_lines_only(spark, folder):
    # Open lines and hits by line, open lines and funding by product; all other lines are read and passed on.
    shuffles = _shuffles_of(spark, folder, "d12_fund_substitutes")
    assert sorted(shuffles) == ["line_id", "line_id", "sku", "sku"]


def test_line_margins_meet_by_line_in_the_last_step(spark, folder):
    # Lines with their unit cost, amounts of originals, scale readings and promotions; orders and products met before.
    assert _shuffles_of(spark, folder, "d12_line_margins") == ["line_id"] * 4


def test_fallback_costs_add_one_shuffle_by_product_at_most(spark, folder):
    # With broadcasts off; the fallback is one row a product, else there is none.
    assert sorted(_shuffles_of(spark, folder, "d12_fill_zero_cost")) == ["line_id"] * 4 + ["sku"] * 2
