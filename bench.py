"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from granero.session import drop_tables, local_session  # noqa: E402
from granero.suite import QUERIES, run  # noqa: E402

HEADLINES = [
    "a01_group_by", "a03_count_distinct", "j02_left_star", "j12_validity", "o02_top_k", "u04_symmetric_difference",
    "i01_upsert", "t02_block_counts", "d01_line_states", "d02_promise_codes", "d04_publication_snapshot",
    "d05_funnel_assortment", "d07_store_board", "d08_product_ranking", "d08_store_ranking", "d09_stockout_ranking",
    "d10_stock_snapshot", "d12_line_margins", "d14_margin_losses", "d16_picking_costs", "d17_guarantee_topup",
    "d20_promotion_list", "d25_store_offers", "d28_availability_feed", "d29_best_promotion", "d31_assign_zones",
    "d31a_safety_stock", "d34_supply_forecast", "d35_promotional_sales", "d36_reconcile_stock", "d38_upload_set",
    "d44_weekday_profile", "d45_slotting_master", "d51_build_orders", "d64_price_profiles", "d70_merge_sales",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    run(QUERIES["a01_group_by"], spark, folder).write.format("noop").mode("overwrite").save()  # JVM warm-up
    names = sys.argv[1:] or HEADLINES
    times = {}
    for name in names:
        start = time.perf_counter()
        run(QUERIES[name], spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        drop_tables()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
