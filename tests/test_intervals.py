"""The interval join against plain loops, and the rows it compares for a key with very many intervals."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from granero.operators import joins

DAY0 = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def made(rng, keys, spans, count):
    facts = [(k, rng.choice([1, 1, 1, 2, 3, 4, None][:keys]), None if rng.random() < 0.03 else rng.randrange(-50, 1500)) for k in range(count)]
    rules = []
    for k in range(spans):
        start = None if rng.random() < 0.03 else rng.randrange(-20, 1400)
        size = rng.choice([0, 0, 1, 3, 4, 15, 16, 17, 63, 64, 65, 300, 5000, -2, None])
        rules.append((k, rng.choice([1, 2, 3, 9, None]), start, None if size is None or start is None else start + size))
    return facts, rules


def frames(spark, facts, rules):
    f = spark.createDataFrame([(k, key, day(d)) for k, key, d in facts], "id long, key long, at date")
    r = spark.createDataFrame([(k, key, day(a), day(b)) for k, key, a, b in rules], "rule long, key long, a date, z date")
    return f, r


@pytest.mark.parametrize("how", ["inner", "left"])
def test_equals_loops(spark, how):
    for seed in range(4):
        facts, rules = made(random.Random(seed), 7, (0, 1, 40, 150)[seed], 300)
        want = []
        for id_, key, at in facts:
            hits = [
                rule for rule, of, a, b in rules
                if key is not None and key == of and at is not None and a is not None and a <= at and (b is None or at <= b)
            ]
            want += [(id_, rule) for rule in hits] or ([(id_, None)] if how == "left" else [])
        got = joins.validity_join(*frames(spark, facts, rules), ["key"], "at", "a", "z", how)
        assert got.columns == ["id", "key", "at", "rule", "a", "z"]
        assert sorted(((r.id, r.rule) for r in got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_short_lists_give_the_same_rows(spark, how):
    f, r = frames(spark, *made(random.Random(8), 7, 60, 300))
    both = [sorted(map(str, join(f, r, ["key"], "at", "a", "z", how).collect())) for join in (joins.validity_join, joins.rate_join)]
    assert both[0] == both[1] and len(both[0]) > 250


def test_two_keys_repeated_facts_and_rules_without_values(spark):
    facts = spark.createDataFrame([(1, "x", day(5))] * 3 + [(1, "y", day(5)), (1, None, day(5))], "k long, s string, at date")
    rules = spark.createDataFrame([(1, "x", day(0), day(9)), (1, "x", day(5), None)], "k long, s string, a date, z date")
    assert joins.validity_join(facts, rules, ["k", "s"], "at", "a", "z").count() == 6
    assert joins.validity_join(facts, rules, ["k", "s"], "at", "a", "z", "left").count() == 8
    same = rules.withColumnsRenamed({"a": "at"})
    assert joins.validity_join(facts.withColumn("z", F.lit(1)), same, ["k", "s"], "at", "at", "z").columns == ["k", "s", "at", "z"]


def test_a_key_with_half_of_all_facts_and_ten_thousand_intervals(spark):
    """Back-to-back intervals of mixed lengths: every fact has one rule, and few more are compared."""
    rng = random.Random(3)
    rules, start = [], 0
    for k in range(10_000):
        size = rng.choice([1, 1, 2, 3, 7, 7, 14])
        rules.append((k, 1, start, start + size - 1))
        start += size
    facts = [(k, 1 if k % 2 else 2 + k, rng.randrange(start)) for k in range(40_000)]
    f, r = frames(spark, facts, rules)
    assert joins.validity_join(f, r, ["key"], "at", "a", "z").count() == 20_000
    spans = r.select("key", F.col("a").alias("_from"), F.col("z").alias("_to"), F.lit(1).alias("_rule"))
    placed = joins._bin_rows(spans, ["key"])
    assert placed.count() <= 20_000
    compared = joins._bin_facts(f, placed, "at", False).join(placed, ["key", "_width", "_bin"]).count()
    assert compared < 8 * 40_000  # a join on the key alone compares 200,000,000


def test_the_hot_key_is_spread_over_its_bins(spark):
    rules = [(k, 1, 10 * k, 10 * k + 9) for k in range(500)]
    facts = [(k, 1, k % 5000) for k in range(20_000)]
    f, r = frames(spark, facts, rules)
    spans = r.select("key", F.col("a").alias("_from"), F.col("z").alias("_to"))
    probes = joins._bin_facts(f, joins._bin_rows(spans, ["key"]), "at", False)
    largest = probes.groupBy("key", "_width", "_bin").count().agg(F.max("count")).first()[0]
    assert largest <= probes.count() / 100
