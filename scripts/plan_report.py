"""Run every registered query and summarise its final (adaptive) physical
plan: join kinds, exchanges, windows, scans. Usage:
python scripts/plan_report.py [sf_dir] [name-substring ...]"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from gridcube.plans.catalog import load  # noqa: E402
from gridcube.session import get_session  # noqa: E402

OPS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
       "Exchange", "Window", "Scan parquet", "Scan csv", "ArrowEvalPython", "BatchEvalPython"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    queries, _ = load()
    print("query," + ",".join(OPS))
    for name, fn in queries.items():
        if pats and not any(p in name for p in pats):
            continue
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(name + "," + ",".join(str(plan.count(op)) for op in OPS), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
