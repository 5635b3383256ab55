"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.plans.queries import QUERIES  # noqa: E402
from ledgerline.session import local_session  # noqa: E402

HEADLINE = [
    "csv_scan_raw", "row_hash", "clean_status", "vendor_canonical", "dedupe_first", "fact_transactions",
    "qa_flags", "match_candidates", "match_greedy", "match_greedy_rounds", "exceptions", "rpt_spend_by_month_vendor",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, int(cpus) if cpus.isdigit() else 8)
    QUERIES["clean_amounts"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the JVM
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
