"""Headline timings: runs the main reports at $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] and prints ONE JSON line.

Each query is executed in full into Spark's ``noop`` sink (every row and
column computed, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "default_rate_by_age_group",
    "build_features",
    "describe_numeric",
    "validate_table",
    "feature_drift_report",
    "mann_whitney_u",
    "roc_auc",
    "psi_smoothed",
    "drift_stream_batch",
    "score_batch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from riskloom.plans.catalog import load_all
    from riskloom.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "16g"})
    cat = load_all()
    # warm-up: JVM, parquet footers, codegen caches
    cat["credit_view"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in only or HEADLINE:
        t0 = time.time()
        df = cat[name].fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
