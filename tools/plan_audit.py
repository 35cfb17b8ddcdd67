"""Print, per registered query, the join strategies and any plan nodes that
do not scale (nested-loop / cartesian joins, Python evaluation)."""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BAD = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
       "FlatMapGroupsInPandas", "MapInPandas")
NODES = ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "Exchange", "HashAggregate",
         "ObjectHashAggregate", "SortAggregate", "Window", "Generate", "TakeOrderedAndProject")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from storefront.plans import registry
    from storefront.session import build_session
    spark = build_session("local[8]", 8)
    # Plan as at scale: no size-based broadcast except the explicit hints.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    for key, fn in registry.queries().items():
        text = plan_text(fn(spark, sf_dir))
        counts = collections.Counter(n for n in NODES for _ in re.finditer(rf"\b{n}\b", text))
        bad = [b for b in BAD if b in text]
        scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
        tables = collections.Counter(re.findall(r"FileScan parquet [^\n]*?/(\w+)\.parquet", text))
        widest = max((len(s.split(",")) for s in scans), default=0)
        print(f"{key:34} {'BAD:' + ','.join(bad) if bad else 'ok':10} "
              + " ".join(f"{k}={v}" for k, v in sorted(counts.items())) + f" widest_scan_cols={widest} scans: " + " ".join(f"{t}={n}" for t, n in sorted(tables.items())))


if __name__ == "__main__":
    main(sys.argv[1:])
