"""Cells of several sizes against the exact test of every point with every ring."""

import math
import random

from pyspark.sql import functions as F

from granero.functions.geo import inside_ring, ring_meets_box
from granero.plans import spatial

RING = "polygon int, ring array<struct<lng: double, lat: double>>"


def star(rng, x, y, radius, corners):
    turn = rng.random()
    points = []
    for k in range(corners):
        angle, far = 2 * math.pi * (k + turn) / corners, radius * rng.uniform(0.3, 1)
        points.append((x + far * math.cos(angle), y + far * math.sin(angle)))
    return [*points, points[0]]


def plane(spark, seed, count=3000):
    rng = random.Random(seed)
    polygons = [(k, star(rng, rng.uniform(0, 30), rng.uniform(-10, 20), 0.02 * 10 ** (k % 4), rng.choice([3, 5, 12, 40]))) for k in range(40)]
    polygons += [(100, [(5.0, 5.0), (10.0, 5.0), (10.0, 10.0), (5.0, 10.0), (5.0, 5.0)]), (101, [(1.0, 1.0)] * 4), (102, [])]
    points = [(k, rng.uniform(0, 30), rng.uniform(-10, 20)) for k in range(count)]
    points += [(count + k, x, y) for k, (x, y) in enumerate([(5.0, 5.0), (5.0, 7.5), (10.0, 10.0), (7.5, 10.0), (9.999999, 9.999999), (1.0, 1.0)])]
    for _, ring in polygons[:20]:
        points += [(len(points), x + 1e-9, y) for x, y in ring[:3]]
    return spark.createDataFrame(points, "id int, lng double, lat double"), spark.createDataFrame(polygons, RING)


def test_same_pairs_as_the_exact_test_alone(spark):
    for seed, cell, refine in ((1, 0.02, 1), (2, 0.3, 0), (3, 5.0, 2)):
        points, polygons = plane(spark, seed)
        plain = points.crossJoin(polygons).where(inside_ring(F.col("ring"), F.col("lng"), F.col("lat"))).select("id", "polygon")
        found = spatial.points_in_polygons(points, polygons, cell, refine)
        assert sorted(found.columns) == ["id", "lat", "lng", "polygon"]
        got = sorted(map(tuple, found.select("id", "polygon").collect()))
        assert got == sorted(map(tuple, plain.collect())) and len(got) > 300


def test_large_zones_have_few_cells_and_few_exact_tests(spark):
    rng = random.Random(5)
    polygons = spark.createDataFrame([(0, star(rng, 15, 5, 20, 30)), *((k, star(rng, 1.0 * k, 5, 0.02, 5)) for k in range(1, 20))], RING)
    points = spark.createDataFrame([(k, rng.uniform(0, 30), rng.uniform(-10, 20)) for k in range(20_000)], "id int, lng double, lat double")
    cells = spatial.cover(polygons, 0.02, refine=3)
    assert cells.groupBy("polygon").count().agg(F.max("count")).first()[0] < 6_000  # cells of the small ones' size: 1,000,000
    assert cells.select("_level").distinct().count() <= 8
    size = spatial._size(F.col("_level"), 0.02)
    placed = cells.select("_level").distinct().crossJoin(points).withColumns({"_cx": F.floor(F.col("lng") / size), "_cy": F.floor(F.col("lat") / size)})
    met = placed.join(cells, ["_level", "_cx", "_cy"]).groupBy("_kind").count().collect()
    kinds = {r["_kind"]: r["count"] for r in met}
    assert kinds["inner"] > 4 * kinds["border"]


def test_edges_that_meet_a_box(spark):
    box = [F.lit(float(v)) for v in (0, 0, 2, 2)]
    rings = {
        "crosses": [(-1, 1), (3, 1), (-1, 1)], "inside": [(0.5, 0.5), (1, 1), (0.5, 0.5)], "corner": [(-1, 1), (1, -1), (-1, 1)],
        "past the corner": [(-1, 0.9), (0.9, -1), (-1, 0.9)], "around": [(-5, -5), (9, -5), (9, 9), (-5, 9), (-5, -5)], "touches": [(2, -3), (2, 9), (2, -3)],
    }
    rows = spark.createDataFrame([(name, [(float(x), float(y)) for x, y in ring]) for name, ring in rings.items()], "name string, ring array<struct<lng: double, lat: double>>")
    met = {r.name for r in rows.where(ring_meets_box(F.col("ring"), *box)).collect()}
    assert met == {"crosses", "inside", "corner", "touches"}


def test_totals_are_those_of_the_pairs_and_follow_the_border_only(spark):
    for seed, cell, per_cell, count in ((1, 0.02, 1, 3000), (2, 0.3, 50, 3000), (3, 5.0, 12, 200)):
        points, polygons = plane(spark, seed, count)
        pairs = spatial.points_in_polygons(points, polygons, cell).groupBy("polygon").agg(F.count("*"), F.sum("id"), F.max("polygon") * 0)
        found = spatial.polygon_totals(points.withColumn("zero", F.lit(0)), polygons, cell, {"ids": "id", "none": "zero"}, per_cell=per_cell)
        assert found.columns == ["polygon", "n", "ids", "none"]
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, pairs.collect()))
    none = spatial.polygon_totals(points.where("id < 0"), polygons, 0.3, {"ids": "id"})
    assert none.count() == 0 and spatial.polygon_totals(points.where("id = 1"), polygons, 0.3, {"ids": "id"}).count() >= 0


def test_cells_keep_only_the_edges_that_decide_about_their_points(spark):
    rng = random.Random(6)
    polygons = spark.createDataFrame([(0, star(rng, 15, 5, 20, 40))], RING)
    kept = spatial.cover(polygons, 0.5, refine=2).where("_kind = 'border'").agg(F.avg(F.size("_edges"))).first()[0]
    assert kept < 10


def test_totals_write_few_parts_once_and_test_most_points_against_one_edge(spark, monkeypatch):
    rng = random.Random(7)
    polygons = spark.createDataFrame([(k, star(rng, rng.uniform(0, 30), rng.uniform(0, 30), 12, 5)) for k in range(30)], RING)
    points = spark.createDataFrame([(k, rng.uniform(0, 30), rng.uniform(0, 30)) for k in range(20_000)], "id int, lng double, lat double")
    written = []
    save = spatial.cut_lineage

    def noted(df):
        written.append(save(df))
        return written[-1]

    monkeypatch.setattr(spatial, "cut_lineage", noted)
    found = spatial.polygon_totals(points, polygons, 0.5, {"ids": "id"}, per_cell=16)
    assert len(written) == 1
    kinds = {r["_kind"]: r["count"] for r in written[0].groupBy("_kind").count().collect()}
    rows = math.ceil(math.sqrt(20_000 / 16))
    assert kinds["edge"] > 3 * kinds["edges"] and sum(kinds.values()) < 12 * rows * 30
    pairs = points.crossJoin(polygons).where(inside_ring(F.col("ring"), F.col("lng"), F.col("lat")))
    plain = pairs.groupBy("polygon").agg(F.count("*"), F.sum("id"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))


def test_totals_of_odd_points_rings_and_measures(spark):
    big = [(-10.0, -10.0), (40.0, -10.0), (40.0, 12.0), (20.0, 12.0), (20.0, 5.0), (-10.0, 5.0), (-10.0, -10.0)]  # level and upright edges
    bow = [(0.0, 0.0), (10.0, 10.0), (10.0, 0.0), (0.0, 10.0), (0.0, 0.0)]  # crosses itself
    twice = [*bow[:1], (8.0, 1.0), (4.0, 9.0), *bow[:1], (8.0, 1.0), (4.0, 9.0), *bow[:1]]  # goes round twice: nothing is inside
    polygons = spark.createDataFrame([(1, big), (2, bow), (2, bow), (3, twice), (None, bow), (4, None)], RING)
    rng = random.Random(8)
    points = [(k, None if k % 3 else k, rng.uniform(-1, 30), rng.uniform(-1, 14)) for k in range(400)]
    points += [(k, k, x, y) for k, (x, y) in enumerate([(5.0, 5.0), (20.0, 5.0), (20.0, 12.0), (0.0, 0.0), (10.0, 10.0)], 500)]
    points += [(600, 1, float("nan"), 1.0), (601, 1, 1.0, float("nan")), (602, 1, float("inf"), 1.0), (603, 1, None, 1.0), (604, 1, 1.0, None), (605, 1, 1.0, float("-inf"))]
    schema = "id int, some int, lng double, lat double"
    for chosen in (points, points[:1], points[500:], [p for p in points if p[1] is None], points[-6:]):
        df = spark.createDataFrame(chosen, schema)
        pairs = df.where("lng < 1e9 AND lat < 1e9").crossJoin(polygons).where(inside_ring(F.col("ring"), F.col("lng"), F.col("lat")))
        plain = pairs.groupBy("polygon").agg(F.count("*"), F.sum("some"))
        for per_cell in (1, 30):
            found = spatial.polygon_totals(df, polygons, 0.5, {"some": "some"}, per_cell=per_cell)
            assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, map(tuple, plain.collect())))
