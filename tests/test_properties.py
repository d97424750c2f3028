"""Properties: merges are idempotent, differences are complete, ranks are permutations, both rank routes agree."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from granero.operators import merge, ranking, sets
from granero.plans.planning import product_ranking
from granero.suite.registry import frame

RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
ROWS = st.dictionaries(st.integers(0, 12), st.one_of(st.none(), st.integers(0, 5)), max_size=10)


def _df(spark, rows):
    return spark.createDataFrame([(k, v) for k, v in rows.items()], "k long, v long")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@RELAXED
@given(old=ROWS, new=ROWS)
def test_merges_are_idempotent(spark, old, new):
    target, updates = _df(spark, old), _df(spark, new)
    for operator in (merge.merge_upsert, merge.merge_insert_absent):
        once = operator(target, updates, ["k"])
        assert _rows(operator(once, updates, ["k"])) == _rows(once)
    assert dict(map(tuple, merge.merge_upsert(target, updates, ["k"]).collect())) == {**old, **new}


@RELAXED
@given(old=ROWS, new=ROWS)
def test_difference_partitions_the_keys(spark, old, new):
    sides = dict(map(tuple, sets.tagged_difference(_df(spark, old), _df(spark, new), ["k"]).collect()))
    assert sides == {**{k: "gone" for k in old.keys() - new.keys()}, **{k: "new" for k in new.keys() - old.keys()}}


def test_difference_ignores_repeats_on_one_side(spark):
    twice = spark.createDataFrame([(1,), (1,)], "k long")
    assert _rows(sets.tagged_difference(twice, twice.limit(0), ["k"])) == [(1, "gone")]


@pytest.mark.parametrize("within", [[], ["store_id"]])
@pytest.mark.parametrize("broadcast_values", [0, 10**6])
def test_sorted_route_equals_plain_windows(spark, folder, within, broadcast_values):
    """One store holds a third of all rows; the range-sorted route must number it like plain windows."""
    sales = frame(spark, folder, "sales").withColumn("store_id", F.expr("CASE WHEN order_id % 3 = 0 THEN 99 ELSE store_id END"))
    ranked = product_ranking(sales, within, broadcast_values=broadcast_values)
    whole, part = Window.partitionBy(F.lit(0)), Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    totals = sales.groupBy(*within, "sku").agg(F.count("sku").alias("frequency"), F.sum("units").alias("units"), F.sum("net").alias("revenue"))
    plain = totals.withColumns({f"{m}_rank": F.dense_rank().over(whole.orderBy(F.col(m).desc())).cast("long") for m in ("frequency", "units", "revenue")})
    plain = plain.withColumn("score", F.expr("5 * frequency_rank + 3 * units_rank + 2 * revenue_rank"))
    plain = plain.withColumn("ranking", F.row_number().over(part.orderBy("score", "sku")).cast("long"))
    columns = sorted(plain.columns)
    assert _rows(ranked.select(columns)) == _rows(plain.select(columns))


def test_ranks_are_a_permutation(spark, folder):
    ranked = product_ranking(frame(spark, folder, "sales"))
    places = [r[0] for r in ranked.select("ranking").collect()]
    assert sorted(places) == list(range(1, len(places) + 1))


def test_positions_restart_in_every_group_and_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", 9), ("b", 5)], "g string, v long")
    got = ranking.positions(df, [F.col("v").asc()], "p", ["g"])
    assert _rows(got.select("g", "v", "p")) == sorted(
        [(None, 1, 1), (None, 3, 2), ("a", 2, 1), ("a", 9, 2), ("b", 5, 1)], key=str
    )


def test_repeated_incoming_keys_without_a_version_raise(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string")
    with pytest.raises(Exception, match="incoming key is repeated"):
        merge.merge_upsert(target, twice, ["k"]).collect()


def test_tables_are_removed(spark):
    from granero import session

    saved = session.cut_lineage(spark.range(3))
    session.drop_tables(saved)
    assert saved._granero_path not in session._TABLES
    with pytest.raises(Exception):
        saved.collect()


def test_a_shared_table_is_written_once_until_its_sources_change(spark, tmp_path):
    from granero import session

    source, made = str(tmp_path / "source.parquet"), []

    def build():
        made.append(1)
        return spark.read.parquet(source)

    def rows():
        return session.shared_table(spark, "test", [source], build).count()

    spark.range(3).write.parquet(source)
    assert rows() == rows() == 3 and len(made) == 1
    session.drop_tables()
    assert rows() == 3 and len(made) == 1
    spark.range(4).write.mode("append").parquet(source)
    assert rows() == 7 and len(made) == 2
