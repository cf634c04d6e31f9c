"""Plan review: per registered query, the executed (adaptive) plan's shape.

``python -m eventide.plans.review <sf_dir> > PLANS.md`` runs every query once
and tabulates shuffles, reused exchanges, scans, pushed filters, sort/hash
aggregates and whole-stage-codegen stages.  Used to check that filters reach
the scan, that a keyed scan's input is shuffled once, and that no plan has a
Cartesian product or a broadcast of unbounded size.
"""

from __future__ import annotations

import re
import sys

from eventide.plans.catalog import QUERIES
from eventide.session import build_session


def shape(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", final)),
        "reused": final.count("ReusedExchange"),
        "broadcasts": final.count("BroadcastExchange"),
        "scans": final.count("FileScan"),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", final)) - {""}),
        "sort_aggs": final.count("SortAggregate"),
        "hash_aggs": final.count("HashAggregate"),
        "windows": len(re.findall(r"\bWindow \[", final)),
        "group_limits": final.count("WindowGroupLimit"),
        "codegen": len(set(re.findall(r"\*\((\d+)\)", final))),
        "cartesian": final.count("CartesianProduct") + final.count("BroadcastNestedLoopJoin"),
        "python": final.count("Python"),
    }


def main(sf_dir: str) -> None:
    spark = build_session("local[8]", 16, app="eventide-review")
    print("| query | shuffles | reused | broadcasts | scans | windows | top-n limits | hash/sort aggs | codegen stages | cartesian | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        df2 = q(spark, sf_dir)
        df2.collect()
        s = shape(df2._jdf.queryExecution().executedPlan().toString())
        pushed = "; ".join(p[:60] for p in s["pushed"]) or "-"
        print(f"| {name} | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {s['scans']} | "
              f"{s['windows']} | {s['group_limits']} | {s['hash_aggs']}/{s['sort_aggs']} | {s['codegen']} | "
              f"{s['cartesian']} | {pushed} |")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
