"""Summarise the physical plans of the batch queries (the plan review):
shuffles, broadcasts, windows, aggregates and what reaches each Parquet scan.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

Streaming queries run their stream when called, so only their batch
read-back would show here; they are listed with the stream plan shape
written by hand (see README)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from neoflow.plans import catalog  # noqa: E402,F401
from neoflow.plans.registry import COVERS, QUERIES  # noqa: E402
from neoflow.session import build_session  # noqa: E402

STREAMING = {"landed_date_range", "stream_to_parquet", "str_01_processing_time", "stream_restart", "stream_rate_limited",
             "live_view", "live_view_preview", "stream_batches_counted", "src_01_feed_scan", "src_04_fail_on_data_loss", "str_04_partition_routing", "start_at_latest",
             "lines_to_records", "records_to_lines", "feed_to_topic", "feed_emission_order",
             "topic_offsets", "topic_lines_numbered", "stream_from_offsets", "stream_offset_gaps", "stream_latest_per_key",
             "growing_lines", "feed_stream_numbers", "described_messages", "mirror_target_offsets"}


def facts(plan: str) -> dict:
    # A reused scalar subquery is printed at every reference: keep its first
    # occurrence only (a subtree is the lines indented deeper than its root).
    seen, kept, skip_below = set(), [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip_below is not None:
            if depth > skip_below:
                continue
            skip_below = None
        m = re.match(r"Subquery (subquery#\d+)", line.lstrip(" :+-"))
        if m:
            if m.group(1) in seen:
                skip_below = depth
                continue
            seen.add(m.group(1))
        kept.append(line)
    plan = "\n".join(kept)
    exch = re.findall(r"Exchange (\w+)", plan)
    return {
        "shuffles": [e for e in exch if e != "SinglePartition"],
        "single": plan.count("Exchange SinglePartition"),
        "broadcast": plan.count("BroadcastExchange"),
        "windows": plan.count("Window ["),
        "hash_aggs": plan.count("HashAggregate("),
        "sort_aggs": plan.count("SortAggregate("),
        "scans": sorted(set(re.findall(r"FileScan (\w+) \[([^\]]*)\][^\n]*?PushedFilters: (\[[^\]]*\])", plan))),
        "codegen": plan.count("*("),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    print("# PLANS\n")
    print(f"Physical plans (before AQE re-planning) of the batch queries at `{sf_dir}`, "
          "from `tools/plan_report.py`. Shuffles are `Exchange` nodes. "
          "Broadcasts are AQE/planner size-checked, never hinted.\n")
    print("| Query | Covers | Shuffles | Single-partition | Broadcast | Window | Agg (hash/sort) | Codegen stages | Scans: columns read / pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    base = sorted(n for n in QUERIES if not re.match(r"^(prj|fan|src|snk|str|top)_\d\d_", n))
    for name in base:
        if name in STREAMING:
            continue
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        f = facts(plan)
        scans = "; ".join(f"{fmt}: {cols.count(',') + 1} cols {pf}" for fmt, cols, pf in f["scans"])
        print(f"| `{name}` | {', '.join(COVERS.get(name, []))} | {', '.join(f['shuffles']) or '-'} | "
              f"{f['single']} | {f['broadcast']} | {f['windows']} | {f['hash_aggs']}/{f['sort_aggs']} | "
              f"{f['codegen']} | {scans} |")
    print("\nStreaming queries (run inside their callables): the landing query is "
          "`FileScan/Kafka -> Project(from_json) -> Project(flatten, codegen) -> "
          "Exchange (REBALANCE on date) -> FileStreamSink partitioned by date`; "
          "no state store; gaps and latest values reduce in mapInArrow before one Exchange to their keyed state. `start_at_latest` adds a join to the per-partition start table "
          "(one row per topic partition, planner-broadcast by its size). "
          "`landed_date_range` reads the landed table through the sink's metadata log with "
          "`PartitionFilters: [isnotnull(date), date >= 1995-01-01, date <= 1996-12-31]`.")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
