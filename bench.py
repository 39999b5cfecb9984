"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "headline_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...,
 "payloads": P, "payloads_per_sec": R}

Each query is run to completion with the ``noop`` sink (every row computed,
nothing collected to the driver).  A small warm-up at sf0.001 runs first so
JVM start-up and first-time code generation are not charged to any query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "normalize_canonical",    # end to end: parse -> dedupe -> detect -> map -> readings
    "rejects",
    "ingest_stats",
    "device_power",
    "fault_stats",
    "records_filter",
    "latest_faults_per_code",
    "raw_current_status",
    "expected_format",
    "detect_rule_join",
    "reprocess",
    "ingest_rate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from gridlake.session import build_session
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          app="gridlake-bench")
    from gridlake.plans.queries import QUERIES
    from gridlake.sources.payloads import payloads

    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        QUERIES["device_power"](spark, warm).write.format("noop").mode("overwrite").save()

    times = {}
    # the durable insert: payloads -> parquet readings that the read queries then use
    from gridlake.plans.queries import stored_readings
    t0 = time.perf_counter()
    stored_readings(spark, sf_dir)
    stored = time.perf_counter() - t0
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    n_payloads = payloads(spark, sf_dir).count()
    total = round(sum(times.values()), 3)
    e2e = times["normalize_canonical"]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "payloads": n_payloads,
        "store_sec": round(stored, 3),
        "stored_payloads_per_sec": round(n_payloads / stored, 1),
        "payloads_per_sec": round(n_payloads / e2e, 1) if e2e > 0 else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
