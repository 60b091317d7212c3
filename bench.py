"""Time the queries and print one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  names, comma-separated (default: the headline list); ``all`` for every query
BENCH_RUNS     timed runs per query, of which the median counts (default 1)

Each query runs once unmeasured, to load classes and compile code, and is then timed. Results are
written to Spark's ``noop`` sink, so every row is produced and none is sent to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from partledger import queries  # noqa: E402
from partledger.session import build_session  # noqa: E402

HEADLINE = [
    "clean_cost", "clean_bom", "clean_revisions", "quarantine_summary", "bom_enriched", "part_cost_view", "dim_part",
    "dim_supplier", "fact_bom_cost", "agg_assembly_cost", "agg_supplier_cost", "agg_part_revision_history",
    "agg_cad_activity", "mart_assembly_cost", "mart_supplier_scorecard", "mart_open_revisions", "api_part_cost_lookup",
    "upsert_cost", "scd2_revision", "bom_revision_as_of", "revision_impact", "star_dim_part", "dq_profile",
    "column_profile", "stream_daily_activity",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(queries.QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            queries.run(name, spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
