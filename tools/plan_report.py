"""Summarise the physical plan of every registered query as a Markdown table.

    python tools/plan_report.py [--sf-dir DIR] > PLANS.md

Counts come from the planned (pre-AQE) physical plan: shuffles by kind, join
strategies, windows, aggregates and scans.  Queries whose construction runs
jobs of its own (checkpoints, writes, streams) are planned too; their
counts cover the returned DataFrame only.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from deskmetrics.plans.catalog import QUERIES  # noqa: E402
from deskmetrics.session import local_session  # noqa: E402

COUNTS = (
    ("hash shuffles", r"Exchange hashpartitioning"),
    ("range shuffles", r"Exchange rangepartitioning"),
    ("single-partition", r"Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("SMJ", r"SortMergeJoin"),
    ("SHJ", r"ShuffledHashJoin"),
    ("BHJ", r"BroadcastHashJoin"),
    ("windows", r"\bWindow \["),
    ("group limits", r"WindowGroupLimit"),
    ("hash aggs", r"\bHashAggregate\("),
    ("sort aggs", r"\bSortAggregate\("),
    ("top-N", r"TakeOrderedAndProject"),
    ("scans", r"FileScan|Scan ExistingRDD|Scan JDBC"),
)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    spark = local_session(8, 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    print("| query | " + " | ".join(c for c, _ in COUNTS) + " |")
    print("|---|" + "---|" * len(COUNTS))
    for name, fn in QUERIES.items():
        try:
            plan = fn(spark, args.sf_dir)._jdf.queryExecution().executedPlan().toString()
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | planning failed: {type(e).__name__} |")
            continue
        cells = [str(len(re.findall(rx, plan))) for _, rx in COUNTS]
        print(f"| {name} | " + " | ".join(cells) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
