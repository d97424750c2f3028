"""Catalogue, assortment and marketplace rules on small hand-written rows."""

from pyspark.sql import functions as F

from granero.plans import assortment, catalogue, marketplace, pricing


def rows(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_every_kind_of_change_is_found_once(spark):
    listed = spark.createDataFrame([(1, 5, False), (1, 9, True), (2, 4, False), (3, 7, False), (4, 2, False)], "sku long, stock long, not_found boolean")
    image = spark.createDataFrame(
        [(2, 4, True, False, True), (3, 6, True, False, True), (4, 2, False, False, True), (5, 1, True, False, True), (6, 1, False, False, True)],
        "sku long, stock long, active boolean, not_found boolean, published boolean",
    )
    changes = catalogue.detect_changes(listed, image)
    assert rows(changes, "sku", "change", "stock") == {(1, "new", 9), (3, "changed", 7), (4, "reactivated", 2), (5, "deactivated", 0)}
    following = catalogue.apply_changes(image, changes)
    assert following.count() == 6 and catalogue.detect_changes(listed, following).count() == 0


def test_one_product_may_change_differently_in_two_stores(spark):
    listed = spark.createDataFrame([(1, 10, 5, False), (1, 20, 4, False), (2, 10, 3, True)], "sku long, store_id long, stock long, not_found boolean")
    image = spark.createDataFrame([(1, 10, 6, True, False, True), (1, 30, 1, True, False, True), (2, 10, 3, True, True, True)], "sku long, store_id long, stock long, active boolean, not_found boolean, published boolean")
    key = ["sku", "store_id"]
    changes = catalogue.detect_changes(listed, image, key)
    assert rows(changes, *key, "change", "stock") == {(1, 10, "changed", 5), (1, 20, "new", 4), (1, 30, "deactivated", 0)}
    following = catalogue.apply_changes(image, changes, key)
    assert following.count() == 4 and catalogue.detect_changes(listed, following, key).count() == 0


def test_upload_set_sends_whole_lists_and_parks_the_rest(spark):
    pair = "sku long, store_id long"
    wanted = spark.createDataFrame([(1, 10), (1, 20), (2, 10), (4, 10), (5, 30)], pair)
    published = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (3, 30)], pair)
    valid = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,)], "sku long")
    stores = spark.createDataFrame([(10,), (20,)], "store_id long")
    excluded = spark.createDataFrame([(4, 10)], pair)
    load = catalogue.upload_set(wanted, published, valid, stores, excluded, "0486")
    # 1 gained a store, 2 is unchanged, 3 is gone, 4 has only an excluded store, 5 sells in a closed store.
    assert rows(load, "sku", "stores", "active") == {(1, "10,20", 1), (3, "0486", 0)}


def test_assortment_exclusions_and_parent_blocks(spark):
    pair = "sku long, store_id long"
    files = spark.createDataFrame([(1, 10, None, None), (1, 20, None, None), (2, 10, None, 7), (3, 10, None, None)], f"{pair}, blocked_store long, blocked_format long")
    excluded = spark.createDataFrame([(1,)], "sku long")
    exceptions = spark.createDataFrame([(1, 20)], pair)
    store_rules = spark.createDataFrame([(3, 10)], pair)
    equivalents = spark.createDataFrame([(9, 2)], "purchase_sku long, sale_sku long")
    parents = spark.createDataFrame([(9, 10, True, True, 4, None)], f"{pair}, listed boolean, active boolean, blocked_store long, blocked_format long")
    got = assortment.load_assortment(files, excluded, exceptions, store_rules, equivalents, parents)
    assert rows(got, "sku", "store_id", "excluded", "blocked_store", "blocked_format") == {
        (1, 10, True, None, None), (1, 20, False, None, None), (2, 10, True, 4, 7), (3, 10, True, None, None),
    }


def test_raw_store_rows_are_cleaned(spark):
    raw = spark.createDataFrame(
        [("53", "123", "UN", "1,5", "09, 02", None, "X", "SI"), ("53", "123", "UN", "1,5", "09, 02", None, "X", "SI"), ("53", "9", "KG", "x", None, "a", None, None)],
        "store string, material string, uom string, stock string, blocked_store string, blocked_format string, substitute string, listed string",
    )
    clean = assortment.clean_assortment(raw)
    assert rows(clean, "store_id", "material", "blocked_store", "blocked_format", "substitute", "listed") == {
        ("0053", "000000000000000123", 9, None, True, True), ("0053", "000000000000000009", None, None, False, False),
    }


def test_bundles_need_every_component(spark):
    parts = spark.createDataFrame([("b", 1, 2, 1), ("b", 2, 1, 3), ("c", 1, 1, 1), ("c", 9, 1, 1)], "bundle string, sku long, quantity int, multiplier int")
    offers = spark.createDataFrame([(1, 10), (1, 20), (2, 20)], "sku long, store_id long")
    assert rows(catalogue.bundle_stores(parts, offers), "bundle", "stores") == {("b", "20")}
    prices = spark.createDataFrame([(1, 100, 120), (2, 50, None)], "sku long, base long, list long")
    assert rows(catalogue.bundle_prices(parts, prices), "bundle", "base", "list") == {("b", 350, None), ("c", None, None)}


def test_delisted_rows_come_back_inactive(spark):
    schema = "sku long, stock long, active int"
    today = spark.createDataFrame([(1, 5, 1)], schema)
    before = spark.createDataFrame([(1, 4, 1), (2, 3, 1), (3, 2, 0)], schema)
    assert rows(catalogue.delist_missing(today, before), "sku", "stock", "active") == {(1, 5, 1), (2, 3, 0)}


def test_days_since_last_sale(spark):
    flags = spark.createDataFrame([(1, 7) + (0, 0, 1) + (1,) * 7, (2, 7) + (0,) * 10, (3, 7) + (1,) + (0,) * 9],
                                  "sku long, store_id long, " + ", ".join(f"day_{d} int" for d in range(1, 11)))
    products = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x")], "sku long, category string")

    def found(threshold):
        limits = spark.createDataFrame([(7, "x", threshold)], "store_id long, category string, threshold int")
        return rows(assortment.immobile_stock(flags, products, limits), "sku")

    assert (found(2), found(10), found(0), found(5)) == ({(1,)}, {(2,)}, {(3,)}, set())


def test_feed_activity_against_safety_stock(spark):
    offered = spark.createDataFrame(
        [(1, 7, "UN", 6, 11, 100, 90), (2, 7, "UN", 6, 12, 100, 190), (3, 7, "KG", 1, 2, 100, None), (4, 7, "KG", 1, 1, 100, None), (5, 7, "XX", 1, 9, 1, None)],
        "sku long, store_id long, uom string, multiplier int, stock long, price long, promo_price long",
    )
    safety = spark.createDataFrame([(5, 7, 10)], "sku long, store_id long, safety long")
    feed = marketplace.availability_feed(offered, safety)
    assert rows(feed, "id", "active", "discount_price", "sale_type") == {
        ("1_6", 0, 90, "U"), ("2_6", 1, 100, "U"), ("3", 1, 100, "WW"), ("4", 0, 100, "WW"), ("5", 0, 1, "ERROR"),
    }


def test_uniform_price_profiles_and_winning_store(spark):
    schema = "id long, sku long, store_id long, min_qty int, price long, list_price long"
    prices = spark.createDataFrame([
        (1, 1, 9, 1, 100, 110), (2, 1, 9, 6, 90, 110), (3, 1, 5, 1, 100, 110), (4, 1, 5, 6, 90, 110),
        (5, 2, 5, 1, 70, 80), (6, 2, 6, 1, 75, 80), (7, 2, 6, 3, None, 80), (8, 2, 6, 6, 50, 80), (9, 1, 4, 1, 1, 2),
    ], schema).withColumns({"valid_from": F.lit("2024-01-01").cast("date"), "valid_to": F.lit(None).cast("date")})
    stores = spark.createDataFrame([(4, 0), (5, 1), (6, 1), (9, 1)], "store_id long, status int")
    got = pricing.price_profiles(prices, stores, 9)
    start = '{"escalas":[{"fechaInicio":"2024-01-01","fechaTermino":null,"nivel1":'
    assert rows(got, "sku", "store_id", "uniform", "scale") == {
        (1, 9, True, start + '{"precio":"90","cantidad":"6"}}]}'),
        (2, 6, False, start + '{"precio":"0","cantidad":"3"},"nivel2":{"precio":"50","cantidad":"6"}}]}'),
    }


def test_each_promotion_rule_removes_rows_alone(spark):
    from dataclasses import replace

    from granero.plans import promotions

    base = dict(mechanic=1, name="Oferta", type=1, organisation="1000", channel="10", valid=True, n_promo=1)
    odd = [
        {"mechanic": 25}, {"name": "BANCO x"}, {"name": "regional"}, {"name": "Solo L012"}, {"type": 3}, {"organisation": "2000"}, {"channel": "70"},
        {"valid": False}, {"n_promo": 7}, {"name": "banco x"},
    ]
    rows_in = [(k, *{**base, **change}.values()) for k, change in enumerate([*odd, {}])]
    df = spark.createDataFrame(rows_in, "k long, mechanic int, name string, type int, organisation string, channel string, valid boolean, n_promo long")
    rules = replace(promotions.OFFERED, promotions=(7,))
    assert [r.k for r in promotions.eligible(df, rules).orderBy("k").collect()] == [9, 10]
    assert [r.k for r in promotions.eligible(df, replace(rules, names_any_case=promotions.MARKET_NAMES)).collect()] == [10]
    assert promotions.eligible(df, promotions.Eligibility()).count() == len(rows_in)
