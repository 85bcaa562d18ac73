"""Summarise the physical plan of every registered query (writes PLANS.md).

    python tools/plan_digest.py [sf_dir] > PLANS.md

Per query: shuffles (Exchange), broadcasts, sort-merge joins, partial/final
window group limits, ordered top-k, aggregates, codegen stages, and for each
file scan the columns it reads and the filters pushed into it.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vulnsift.queries import queries  # noqa: E402
from vulnsift.session import local_session  # noqa: E402


def digest(plan: str) -> dict:
    lines = plan.splitlines()
    count = lambda pat: sum(1 for ln in lines if re.search(pat, ln))
    scans = [ln for ln in lines if "ReadSchema" in ln or "PushedFilters" in ln]
    return {
        "file_scans": count(r"FileScan"),
        "shuffles": count(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning)"),
        "single": count(r"Exchange SinglePartition"),
        "reused": count(r"ReusedExchange"),
        "smj": count(r"SortMergeJoin"),
        "bhj": count(r"BroadcastHashJoin"),
        "group_limit": count(r"WindowGroupLimit"),
        "top_k": count(r"TakeOrderedAndProject"),
        "aggregates": count(r"HashAggregate|ObjectHashAggregate|SortAggregate"),
        "scans": scans,
    }


COLUMNS = ("file_scans", "shuffles", "single", "reused", "bhj", "smj", "group_limit", "top_k", "aggregates")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    rows = []
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        df.collect()  # of this very plan, so that AQE's final form is what prints
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        rows.append((name, digest(plan)))
    print("# Physical plan digest\n")
    print(f"Generated by `tools/plan_digest.py` at `{sf_dir}` on local mode after one execution (AQE final plans of")
    print("the returned frame; scalar subqueries and jobs that a query runs while it is built aren't in it).")
    print("`shuffles` counts hash, single-partition and range exchanges, `single` those to one partition: partial")
    print("aggregates or top-k rows of each task. `reused` counts exchanges that Spark reuses within the plan.\n")
    print("| query | " + " | ".join(c.replace("_", " ") for c in COLUMNS) + " |")
    print("|---" * (len(COLUMNS) + 1) + "|")
    for name, d in rows:
        print(f"| {name} | " + " | ".join(str(d[c]) for c in COLUMNS) + " |")
    print("\n## Scans\n")
    for name, d in rows:
        seen = []
        for s in d["scans"]:
            s = re.sub(r"\s+", " ", s.strip())
            m = re.search(r"ReadSchema: (struct<[^>]*>)", s)
            f = re.search(r"PushedFilters: (\[[^\]]*\])", s)
            item = (m.group(1) if m else "") + (f" pushed={f.group(1)}" if f and f.group(1) != "[]" else "")
            if item and item not in seen:
                seen.append(item)
        print(f"- **{name}**: " + "; ".join(seen))
    spark.stop()


if __name__ == "__main__":
    main()
