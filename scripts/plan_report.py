"""Summarise the executed physical plan of every registered query.

For each query: shuffles (Exchange), broadcasts and how they were chosen,
Python steps, sort-based aggregates, and each scan's read schema, so plan
regressions show up in review.  Usage: plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    lines = plan.split("\n")
    count = lambda pat: sum(1 for ln in lines if re.search(pat, ln))
    scans = []
    for ln in lines:
        if "FileScan" in ln or "Scan parquet" in ln:
            m = re.search(r"ReadSchema: (struct<[^>]*>)", ln)
            name = re.search(r"\[file:[^\]]*/([a-z_]+)\.parquet\]", ln)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", ln)
            scans.append(((name.group(1) if name else "?"),
                          (m.group(1) if m else "?"), (pushed.group(1) if pushed else "")))
    return {
        "shuffles": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition"),
        "broadcasts": count(r"BroadcastExchange"),
        "python": count(r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas"),
        "sort_aggregates": count(r"SortAggregate"),
        "sort_merge_joins": count(r"SortMergeJoin"),
        "scans": scans,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from parley.plans import catalog
    from parley.session import build_session
    spark = build_session()
    print(f"# Executed plans ({os.path.basename(sf)}, AQE final plans)\n")
    print("| query | shuffles | broadcasts | python steps | sort aggs | SMJ | scans (table: read schema) |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in catalog.queries().items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(re.sub(r"#\d+L?", "", plan))
        scans = "; ".join(f"{t}: {schema}" for t, schema, _ in s["scans"])
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['python']} | "
              f"{s['sort_aggregates']} | {s['sort_merge_joins']} | {scans} |")
    spark.stop()


if __name__ == "__main__":
    main()
