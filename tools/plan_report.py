"""Summarise the physical plans of the headline queries into PLANS.md.

For each query: exchanges (with partitioning), join strategies, aggregate
and window operators, pushed / partition filters, and whether any step runs
on a single partition. Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ["hist_summary", "new_summary", "train_features", "top5_ids_hist",
            "category_props_hist", "target_summary", "split_stratified", "lag_density",
            "factor_code", "term_order_hist"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> dict:
    ops = Counter()
    for m in re.finditer(r"^\(\d+\) (\w+)", text, re.M):
        ops[m.group(1)] += 1
    parts = re.findall(r"Arguments: (hashpartitioning\([^\]]*?\d+\)|rangepartitioning\([^\]]*?\d+\)|SinglePartition)", text)
    parts = [re.sub(r"#\d+L?", "", p) for p in parts]
    pushed = sorted({re.sub(r"#\d+L?", "", p) for p in re.findall(r"PushedFilters: (\[.+\])", text)
                     if p != "[]"})
    pfilters = sorted({re.sub(r"#\d+L?", "", p) for p in re.findall(r"PartitionFilters: (\[.+\])", text)
                       if p != "[]"})
    # What each single-partition exchange carries (its input columns).
    single = []
    for block in re.split(r"\n\n", text):
        if block.startswith("(") and " Exchange" in block.splitlines()[0] and "SinglePartition" in block:
            m = re.search(r"Input \[\d+\]: \[(.*)\]", block)
            single.append(re.sub(r"#\d+L?", "", m.group(1)) if m else "?")
    return {"ops": ops, "partitioning": parts, "pushed": pushed, "partition_filters": pfilters,
            "single_partition": single}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from cardgrain.plans.catalog import queries
    from cardgrain.session import build_session, checkpoint_dir
    spark = build_session("local[8]", shuffle_partitions=16)
    checkpoint_dir(spark)
    qs = queries()
    print("# PLANS — physical plan summaries of the headline queries\n")
    print(f"Generated by `tools/plan_report.py` over `{sf_dir}` (plans before AQE re-planning;"
          " AQE may turn a sort-merge join into a broadcast join at run time).\n")
    for name in HEADLINE:
        s = summarise(plan_text(qs[name](spark, sf_dir)))
        interesting = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
                       "ShuffledHashJoin", "HashAggregate", "ObjectHashAggregate",
                       "SortAggregate", "Window", "WindowGroupLimit", "Expand", "Scan",
                       "FlatMapGroupsInPandas", "BroadcastNestedLoopJoin", "CartesianProduct")
        ops = ", ".join(f"{k} x{v}" for k, v in sorted(s["ops"].items()) if k in interesting)
        print(f"## {name}\n")
        print(f"- operators: {ops}")
        print(f"- shuffle partitioning: {'; '.join(sorted(set(s['partitioning']))) or 'none'}")
        if s["pushed"]:
            print(f"- pushed filters: {'; '.join(s['pushed'])}")
        if s["partition_filters"]:
            print(f"- partition filters: {'; '.join(s['partition_filters'])}")
        if s["single_partition"]:
            carried = "; ".join(f"[{c}]" for c in s["single_partition"])
            print(f"- single-partition exchanges carry: {carried}\n")
        else:
            print("- single-partition exchanges: none\n")


if __name__ == "__main__":
    main()
