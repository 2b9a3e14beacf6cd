"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import time

from weir.catalog import load_all
from weir.config import session

HEADLINE = [
    "a1_windowed_key_count",
    "a2_windowed_key_sum",
    "a4_re_aggregate",
    "a6_tick_global_count",
    "a7_running_total",
    "a8_word_count",
    "a9_running_word_count",
    "a14_column_rollup",
    "a15_cells_to_map",
    "a17_throughput_stats",
    "w1_top_n_per_group",
    "s10_rate_view",
    "j1_enrich_first",
    "j2_lookup_all",
    "j5_merge_add",
    "k5_upsert",
    "k10_bulk_pack",
    "p1_parse_json_typed",
    "plan_web_etl",
    "plan_vehicle_enrich",
    "plan_event_counter",
    "t1_tumbling_window_stream",
    "t10_stream_static_enrich",
    "k1_delimited_files_sink",
    "k7_wide_merge_write",
    "s8_key_range_scan",
    "t3_late_partials_merged",
    "t6_replay_dedup",
    "t9_per_key_state",
    "plan_web_etl_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load_all()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(HEADLINE[0])  # start-up and first compilation
    seconds = {name: round(min(run(name) for _ in range(2)), 3) for name in HEADLINE}
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1).rstrip(".")) if scale else None,
    }))


if __name__ == "__main__":
    main()
