"""Physical-plan summary of every registered query (for plan reviews).

usage: python tools/plan_report.py [sf_dir] > docs/PLANS.md

For each query: number of shuffles (Exchange, reused ones counted apart), join
strategies, aggregate operators, windows, Python evaluation nodes, and the
filters / columns pushed into each Parquet scan.  Plans are the final ones: the shuffles
run, and joins are what AQE made of them.  Queries whose builder writes files or trains
models are listed without a plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkpanel.plans import registry  # noqa: E402
from sparkpanel.session import get_session  # noqa: E402

SIDE_EFFECTS = {"decision_tree_eval", "random_forest_eval", "gbt_eval", "feature_importance", "forest_per_item",
                "tree_rules", "stream_kpi_refresh", "stream_daily_counts", "multi_file_match_counts",
                "merge_part_files", "scan_csv_roundtrip", "preagg_lookup", "narrowed_types", "typed_insert",
                "json_landing", "rule_scores", "small_tree_leaves", "small_tree_importance"}
OPS = ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
       "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window", "TakeOrderedAndProject",
       "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "Generate", "Expand"]


def summarize(plan: str) -> dict:
    out = {"exchanges": len(re.findall(r"(?<!Reused)Exchange ", plan)),
           "reused": plan.count("ReusedExchange")}
    for op in OPS:
        n = len(re.findall(rf"\b{op}\b", plan))
        if n:
            out[op] = n
    scans = []
    for m in re.finditer(r"FileScan parquet [^\n]*", plan):
        s = m.group(0)
        table = re.search(r"/([a-z_]+)\.parquet\]", s)
        pushed = re.search(r"PushedFilters: \[([^\]]*)", s)
        schema = re.search(r"ReadSchema: struct<([^>]*)>", s)
        scans.append(f"{table.group(1) if table else '?'}: cols={len(schema.group(1).split(',')) if schema else '?'}"
                     f" pushed=[{(pushed.group(1) if pushed else '')[:80]}]")
    out["scans"] = scans
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(shuffle_partitions=8)
    registry.load_all()
    qs = registry.QUERIES
    print("# Physical plans (generated by tools/plan_report.py)\n")
    print(f"Scale folder: `{sf}`; final plans.\n")
    print("| query | shuffles (reused) | operators | Parquet scans (columns read, pushed filters) |")
    print("| --- | --- | --- | --- |")
    for name in sorted(qs):
        if name in SIDE_EFFECTS:
            print(f"| {name} | – | writes files or fits models while building; see module docstring | – |")
            continue
        execution = qs[name](spark, sf)._jdf.queryExecution()
        execution.toRdd()  # runs the shuffles, which fixes the final plan
        plan = execution.executedPlan().toString().split("== Initial Plan ==")[0]
        s = summarize(plan)
        ops = ", ".join(f"{k} x{v}" for k, v in s.items() if k not in ("exchanges", "reused", "scans"))
        scans = "<br>".join(dict.fromkeys(s["scans"]))
        print(f"| {name} | {s['exchanges']} ({s['reused']}) | {ops} | {scans} |")


if __name__ == "__main__":
    main()
