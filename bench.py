"""Time the headline queries: one warm-up at the smallest scale, then one full run each into a sink that keeps nothing.

Prints one JSON line. BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans.catalogue import QUERIES  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINES = [
    "slide_event_min", "tumble_event_min", "slide_avg_decimal", "tumble_proc_min", "vehicle_window_agg", "running_count",
    "ema_last", "late_split", "group_samples", "latest_by_key", "decode_change", "filter_project_dt_hr", "filter_enum",
    "json_fields", "json_lenient", "unpack_batches", "hash_partition", "validate_split", "decimal_round", "scalar_udf",
    "multi_arg_udf", "async_enrich", "lake_upsert", "apply_changes", "stream_slide_min", "stream_keyed_count",
    "stream_running_count", "stream_log_rows",
]

# The table a query's rate is given for, where that is not the event table.
TABLE = {
    "latest_by_key": "orders", "decode_change": "orders", "apply_changes": "orders", "lake_upsert": "customer",
    "filter_enum": "lineitem", "decimal_round": "lineitem", "multi_arg_udf": "lineitem", "unpack_batches": "documents",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINES
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in names:
            QUERIES[name].run(spark, small).write.format("noop").mode("overwrite").save()
    rows = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet").count() for name in {"events", *TABLE.values()}}
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_second": {n: round(rows[TABLE.get(n, "events")] / s) for n, s in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "rows": rows,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
