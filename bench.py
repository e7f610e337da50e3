"""Wall time of the headline queries, the median of three runs each. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from wattloom.session import build_session

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import catalog.all_queries  # noqa: E402,F401
from catalog.registry import CATALOG, run  # noqa: E402

HEADLINE = (
    "margin_by_zone arbitrage_hourly arbitrage_interval capacity_hourly telemetry_enriched device_registry price_mart "
    "dispatch_conformance full_cycles soc_price_correlation sales_star sales_metrics top_products customer_segments "
    "consumption_by_heatpump_ownership bills_and_ownership invoice_summary orphan_report csv_load document_search "
    "refreshed_term_index page_texts stream_capacity").split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = list(CATALOG) if "--all" in sys.argv else HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    run("margin_by_zone", spark, sf_dir).write.format("noop").mode("overwrite").save()  # start up, not measured
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(sorted(taken)[len(taken) // 2], 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
