"""Boundary rules on small hand-written rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from granero.functions import dates, geo, keys, numbers
from granero.operators import joins, ranking
from granero.plans import customers, dimensions, fulfilment, intake, logistics, planning, promotions, spatial
from granero.session import shared_folder
from granero.sources import scans


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def pairs(df):
    return dict(map(tuple, df.collect()))


LINES = "line_id long, substitute_of long, sku long, uom string, asked long, picked long, multiplier decimal(8,4)"


def test_found_rate_boundaries(spark):
    one_unit = Decimal("1")
    lines = spark.createDataFrame([
        (1, None, 1, "kg", 10, None, one_unit), (2, None, 2, "kg", 10, None, one_unit), (3, None, 2, "kg", 10, None, one_unit),
        (4, None, 3, "un", 2, 2, one_unit), (5, None, 3, "un", 2, None, one_unit), (6, None, 3, "un", 2, 9, one_unit),
        (7, 6, 3, "un", 1, 1, one_unit), (8, None, 3, "kg", 0, None, one_unit),
    ], LINES)
    weights = spark.createDataFrame([(1, 3500), (1, 3500), (2, 7000), (3, 8000)], "line_id long, weight_g long")
    products = spark.createDataFrame([(1, "meat"), (2, "fruit"), (3, None)], "sku long, category string")
    states = pairs(fulfilment.line_states(lines, weights, products, ["meat"]).select("line_id", "state"))
    # Meat at exactly 70 % over two readings is complete, fruit needs exactly 80 %; nothing asked is never complete.
    assert states == {1: 3, 2: 1, 3: 3, 4: 3, 5: 1, 6: 2, 7: None, 8: 1}


def _promise(spark, delivered, state=90, now="2024-05-10 12:00:00"):
    day, start = dt.date(2024, 5, 10), dt.datetime(2024, 5, 10, 10)
    dispatches = spark.createDataFrame(
        [(1, 7, dt.date(2024, 5, 1), start, start), (2, 7, day, start, start + dt.timedelta(hours=2))],
        "id long, order_id long, promised date, window_start timestamp, window_end timestamp",
    )
    orders = spark.createDataFrame([(7, state)], "order_id long, state int")
    changes = spark.createDataFrame(
        [(1, 7, 90, dt.datetime(2024, 5, 1))] + ([(2, 7, 90, delivered)] if delivered else []), "id long, order_id long, new_state int, created timestamp"
    )
    changes = changes if delivered else changes.limit(0)
    return tuple(fulfilment.promise_codes(dispatches, orders, changes, now).select("on_day", "on_time").first())


@pytest.mark.parametrize("delivered,expected", [
    (dt.datetime(2024, 5, 10, 12, 20), (10, 10)), (dt.datetime(2024, 5, 10, 12, 21), (10, 30)),
    (dt.datetime(2024, 5, 10, 9, 59), (10, 20)), (dt.datetime(2024, 5, 9, 23, 0), (20, 20)),
    (dt.datetime(2024, 5, 11, 0, 0), (30, 30)),
])
def test_delivery_grace(spark, delivered, expected):
    assert _promise(spark, delivered) == expected


def test_open_promises(spark):
    assert _promise(spark, None, now="2024-05-10 11:00:00") == (40, 40)
    assert _promise(spark, None, now="2024-05-10 11:30:00") == (40, 999)
    assert _promise(spark, None, now="2024-05-12 11:00:00") == (999, 999)
    assert _promise(spark, None, state=100) == (0, 0)


def _safety(spark, units, minimum=None, weight=None, excluded=False, exempt=False, **options):
    pair = "sku long, store_id long"
    sales = spark.createDataFrame([(1, 1, dt.date(2024, 5, 9), units)] if units else [], f"{pair}, day date, units long")
    none = spark.createDataFrame([], pair)
    here = spark.createDataFrame([(1, 1)], pair)
    minima = spark.createDataFrame([(1, 1, minimum)] if minimum is not None else [], f"{pair}, minimum long")
    weights = spark.createDataFrame([(1, weight)] if weight else [], "store_id long, weight double")
    result = planning.safety_stock(
        here, sales, minima, here if exempt else none, weights, here if excluded else none, "2024-05-10", **options
    )
    return result.first()["safety_stock"]


def test_safety_stock_rules(spark):
    assert _safety(spark, None) == 0
    assert _safety(spark, 3) == 0  # a quarter of three is below one
    assert _safety(spark, 4) == 1
    assert _safety(spark, 18) == 4  # 4.5 rounds half-even
    assert _safety(spark, 22) == 6  # 5.5 rounds half-even
    assert _safety(spark, 400) == 50
    assert _safety(spark, 40, minimum=3) == 3
    assert _safety(spark, 40, minimum=3, exempt=True) == 10
    assert _safety(spark, 40, minimum=0) == 10
    assert _safety(spark, 40, weight=1.5) == 15
    assert _safety(spark, 40, excluded=True) == 0
    assert _safety(spark, 40, event_weeks=[(2024, 19)]) == 0


def test_store_weight_is_clipped(spark):
    rows = [(1, dt.date(2024, 5, 8), 3, False, i) for i in range(10)] + [(2, dt.date(2024, 5, 8), 1, False, i) for i in range(10)]
    states = spark.createDataFrame(rows, "store_id long, day date, state int, substitute boolean, line_id long")
    stored = spark.createDataFrame([(1, 0.9), (2, 0.9)], "store_id long, weight double")
    got = {(r["store_id"], r["age"]): r["weight"] for r in fulfilment.store_weights(states, stored, "2024-05-13").collect()}
    assert got == {(1, 1): 0.9, (2, 1): 0.9, (1, 0): 0.3, (2, 0): 1.5}


@pytest.mark.parametrize("lead,expected", [(0, 0), (1, 2), (7, 28), (9, 33)])
def test_lead_time_wraps_around_the_week(spark, lead, expected):
    profile = F.array(*[F.lit(float(i + 1)) for i in range(7)])
    assert one(spark, planning.cyclic_demand(profile, F.lit(1), F.lit(lead))) == expected


def test_scalar_helpers(spark):
    assert one(spark, keys.zero_pad(F.lit("123456"), 4)) == "123456"
    assert one(spark, keys.normal_unit(F.lit(" st "))) == "UN"
    assert one(spark, keys.first_number(F.lit("09, 02"))) == "09"
    assert one(spark, keys.first_number(F.lit("none"))) is None
    assert one(spark, keys.decimal_comma(F.lit("1,5"))) == Decimal("1.500")
    assert one(spark, keys.decimal_comma(F.lit("x"))) is None
    assert one(spark, numbers.clip(F.lit(None).cast("double"), 0.3, 1.5)) is None
    assert one(spark, numbers.truncate(F.lit(-1.7))) == -1
    assert one(spark, numbers.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, numbers.net_of_vat(F.lit(119))) == 100
    assert one(spark, dates.iso_year(F.lit("2021-01-02").cast("date"))) == 2020
    assert one(spark, dates.sunday_zero(F.lit("2024-05-12").cast("date"))) == 0


def test_distance_and_rings(spark):
    km = one(spark, geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    assert abs(km - 111.195) < 0.01
    corners = [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4), (0, 0)]
    ring = F.array(*[F.struct(F.lit(float(x)).alias("lng"), F.lit(float(y)).alias("lat")) for x, y in corners])
    assert one(spark, geo.inside_ring(ring, F.lit(1.0), F.lit(0.4)))
    assert not one(spark, geo.inside_ring(ring, F.lit(2.0), F.lit(2.0)))  # in the concave notch


def test_district_takes_the_first_polygon_and_zones_take_all(spark):
    def square(name, position, low):
        points = [(low, low), (low + 10, low), (low + 10, low + 10), (low, low + 10), (low, low)]
        return (name, position, [(float(x), float(y)) for x, y in points])

    polygons = spark.createDataFrame(
        [square("b", 1, 0), square("a", 2, 5)], "polygon string, position int, ring array<struct<lng: double, lat: double>>"
    )
    points = spark.createDataFrame([(1, 6.0, 6.0), (2, 12.0, 12.0), (3, 50.0, 50.0)], "order_id long, lng double, lat double")
    zones = sorted(tuple(r) for r in spatial.assign_zones(points, polygons, 3.0).select("order_id", "polygon").collect())
    assert zones == [(1, "a"), (1, "b"), (2, "a")]
    assert pairs(spatial.assign_district(points, polygons, 3.0)) == {1: "b", 2: "a"}


def test_broken_json_and_missing_keys_are_null(spark):
    raw = spark.createDataFrame([(1, 0, "{oops"), (2, 0, '{"old_store": "4"}')], "id long, created_unix long, extra string")
    rows = {r["id"]: (r["old_store"], r["new_store"]) for r in intake.status_changes(raw).collect()}
    assert rows == {1: (None, None), 2: ("4", None)}


def test_billing_month_cuts_at_the_25th(spark):
    def month(day):
        return one(spark, logistics.billing_month(F.lit(day).cast("date")))

    assert [month(d) for d in ("2022-05-25", "2022-05-26", "2022-12-26")] == [202205, 202206, 202301]


def test_promotion_encoding_reasons(spark):
    schema = "store_id string, sku string, name string, kind string, qty_n double, qty_m double, total_price double, start_day date, end_day date"
    a, z = dt.date(2024, 1, 1), dt.date(2024, 1, 9)
    rows = [
        ("1", "1", "x", "Combinacion NXM", 3.0, 2.0, None, a, z), ("1", "2", "x", "COMBINACION NX$", 3.0, None, 12990.0, a, z),
        ("1", "3", "x", "COMBINACION NXM", 2.0, 2.0, None, a, z), ("1", "4", "x", "COMBINACION NX$", 1.0, None, 990.0, a, z),
        ("1", "5", "x", "COMBINACION NX$", 2.5, None, 990.0, a, z), ("1", "6", " ", "COMBINACION NXM", 3.0, 2.0, None, a, z),
        ("1", "7", "x", "COMBINACION NXM", 3.0, 2.0, None, z, a),
    ]
    got = {r["sku"]: (r["reject_reason"], r["type_format"], r["description"]) for r in promotions.encode_promotions(spark.createDataFrame(rows, schema)).collect()}
    assert got["1"] == (None, "L3_P2", "Compra 3 y paga 2")
    assert got["2"] == (None, "N3_M12990", "3 unidades por $12.990")
    assert [got[k][0] for k in "34567"] == ["pays all", "bundle of one", "bad quantity", "missing name", "ends before start"]


def test_unit_price_of_each_promotion_kind(spark):
    rows = [("strikethrough", 100, 80, 0, 0, 0), ("bundle_price", 100, 0, 250, 3, 0), ("free_item", 100, 0, 0, 4, 3), ("other", 0, 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "kind string, regular_price long, strike_price long, total_price long, qty_n long, qty_m long")
    assert [r[0] for r in df.select(promotions.unit_price()).collect()] == [80.0, 250 / 3, 75.0, 9999999.0]


def test_open_ended_validity(spark):
    facts = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (1, dt.date(2030, 1, 1)), (2, dt.date(2024, 1, 5))], "k long, day date")
    rules = spark.createDataFrame([(1, dt.date(2024, 1, 5), None, 9)], "k long, a date, z date, rate long")
    assert joins.validity_join(facts, rules, ["k"], "day", "a", "z").count() == 2
    assert joins.validity_join(facts, rules, ["k"], "day", "a", "z", "left").where("rate IS NULL").count() == 1


def test_top_k_by_column_keeps_ties_up_to_the_cap(spark):
    rows = [(s, i, 5 if i < 20 else 1) for s in (1, 2) for i in range(25)]
    df = spark.createDataFrame(rows, "store long, sku long, n long").withColumn("k", F.expr("CASE WHEN store = 1 THEN 1 ELSE 2 END"))
    got = ranking.top_k_by_column(df, ["store"], [F.col("n").desc()], [F.col("sku").asc()], F.col("k"), 15)
    assert pairs(got.groupBy("store").count()) == {1: 15, 2: 15}


def test_zone_history_keeps_the_deletion_date(spark):
    d = [dt.date(2024, 1, i) for i in range(1, 6)]
    history = spark.createDataFrame(
        [("gone", "r", True, d[0], d[0], None), ("dead", "r", False, d[0], d[0], d[1]), ("back", "r", False, d[0], d[0], d[1])],
        "polygon string, ring string, active boolean, created date, updated date, deleted date",
    )
    today = spark.createDataFrame([("dead", "r", False), ("back", "r", True), ("new", "r", True)], "polygon string, ring string, active boolean")
    rows = {r["polygon"]: (r["active"], r["updated"], r["deleted"]) for r in spatial.zone_history(history, today, d[4]).collect()}
    assert rows == {
        "gone": (False, d[0], d[3]), "dead": (False, d[0], d[1]), "back": (True, d[4], None), "new": (True, d[4], None),
    }


def test_carrier_references_are_normalised(spark):
    assert one(spark, dimensions.carrier_store(F.lit(" 581-2 "))) == "0581-2"
    assert one(spark, dimensions.carrier_store(F.lit("X9"))) == "X9"


def test_incremental_scan_needs_a_column(spark):
    with pytest.raises(ValueError):
        scans.scan_since(spark.range(1))


def test_session_metrics_keep_days_of_every_feed(spark):
    a = spark.createDataFrame([(dt.date(2024, 1, 1), 5)], "day date, sessions long")
    b = spark.createDataFrame([(dt.date(2024, 1, 2), 7)], "day date, sessions long")
    rows = sorted(tuple(r) for r in customers.session_board({"app": a, "web": b}).collect())
    assert rows == [(dt.date(2024, 1, 1), 5, None), (dt.date(2024, 1, 2), None, 7)]


def test_shared_folder_comes_from_the_context(spark):
    assert shared_folder(spark) == spark.sparkContext.getCheckpointDir()


def test_name_rules_are_one_expression_equal_to_their_patterns(spark):
    from functools import reduce

    names = ["MFC x", "a MFC", "mfc", "BANCO", " LOC", "x LOC y", "xLOC", "reGIO", "REGIÓ", "L012 a", "L0089", "50%", "a_b", "line\nMFC", "", None, "tail.", "abXcd"]
    rows = spark.createDataFrame([(name, 1, 4, True) for name in names], "name string, mechanic int, type int, valid boolean")
    for own, other, pattern in ((("%MFC%", "% LOC%", "BANCO"), (), None), (("a%d", "tail_"), ("%regio%", "BAN%"), "L(0[0-9]{2})"), ((), (), None)):
        rules = promotions.Eligibility(names=own, names_any_case=other, name_pattern=pattern)
        taken = [r.name for r in promotions.eligible(rows, rules).collect()]
        unwanted = reduce(lambda a, b: a | b, [F.col("name").like(p) for p in own] + [F.col("name").ilike(p) for p in other] + ([F.col("name").rlike(pattern)] if pattern else []), F.lit(False))
        assert taken == [r.name for r in rows.where(~unwanted).collect()]
