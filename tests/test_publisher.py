"""The payload data source: all or nothing, within the failure budget."""

import json
import os

import pytest
from pyspark.sql import functions as F

from granero.sources import publisher


def payloads(spark, rows):
    return spark.createDataFrame(rows, publisher.PAYLOADS).repartition(4)


def array(n):
    return json.dumps([{"sku": k} for k in range(n)])


def left(path, folder):
    return sorted(os.listdir(f"{path}/{folder}")) if os.path.exists(f"{path}/{folder}") else []


def test_publications_add_up_and_read_back(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(f"store{k}", k, 10, array(10)) for k in range(30)]
    publisher.publish(payloads(spark, rows), path)
    publisher.publish(payloads(spark, [("Ñuñoa \"x\"", 0, 1, array(1))]), path)
    got = sorted(tuple(r) for r in publisher.published(spark, path).collect())
    assert got == sorted([(key, chunk, text) for key, chunk, _, text in rows] + [("Ñuñoa \"x\"", 0, array(1))])
    assert left(path, "_sending") == [] and len(left(path, "outbox")) == 31 and len(left(path, "published")) == 2


@pytest.mark.parametrize("bad,items,good,fails", [(1, 100, 5, False), (2, 100, 5, True), (1, 501, 100, True), (1, 500, 100, False), (0, 0, 0, False)])
def test_the_failure_budget(spark, tmp_path, bad, items, good, fails):
    """At most a fifth of the records and at most 500 of them may fail."""
    path = str(tmp_path / "out")
    rows = [("bad", k, items, "no array") for k in range(bad)] + [("good", k, 100, array(100)) for k in range(good)]
    if fails:
        with pytest.raises(Exception, match="given up"):
            publisher.publish(payloads(spark, rows), path)
        assert left(path, "outbox") == left(path, "published") == left(path, "_sending") == []
    else:
        publisher.publish(payloads(spark, rows), path)
        assert len(left(path, "outbox")) == good


def test_requests_over_the_limit_and_nulls_count_as_failed(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("a", 0, 20, array(20)), ("b", 0, 501, array(501)), ("c", 0, 1, None), ("d", 0, 3000, array(400))]
    publisher.publish(payloads(spark, rows), path, budget_rows=502)
    assert sorted(r.key for r in publisher.published(spark, path).collect()) == ["a", "d"]
    listed = json.load(open(f"{path}/published/{left(path, 'published')[0]}"))
    assert (listed["items"], listed["failed"]) == (3522, 502)


def test_a_failed_task_leaves_no_half_payload(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = payloads(spark, [(f"k{k}", k, 1, array(1)) for k in range(40)])
    broken = rows.withColumn("payload", F.when(F.col("chunk") == 39, F.raise_error(F.lit("lost"))).otherwise(F.col("payload")))
    with pytest.raises(Exception, match="lost"):
        publisher.publish(broken, path)
    assert left(path, "outbox") == left(path, "published") == left(path, "_sending") == []
    publisher.publish(rows, path)
    os.makedirs(f"{path}/outbox", exist_ok=True)
    with open(f"{path}/outbox/stray.json", "w") as out:  # of a writer that ended while it moved files
        out.write(json.dumps({"key": "stray", "chunk": 1, "payload": "[]"}))
    assert publisher.published(spark, path).count() == 40
