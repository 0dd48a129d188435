"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from checks.catalog import QUERIES
from meterline.session import get_spark

HEADLINE = (
    "silver_trips",
    "clean_rules",
    "quarantine",
    "contract_violations",
    "enrich_roles",
    "decode_codes",
    "conform_union",
    "avg_by_month",
    "avg_by_hour",
    "avg_by_month_orders",
    "avg_by_hour_events",
    "column_profile_orders",
    "stratified_sample",
    "dedup_per_file",
    "star_rejoined",
    "event_transitions",
    "event_batches",
    "run_log",
    "run_tree",
    "write_read",
    "gold_sql",
    "silver_from_files",
    "ingest_stream",
    "compact",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["avg_by_month_orders"](spark, folder).collect()  # start the JVM's engines
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
