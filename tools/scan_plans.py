"""Print the join and Python nodes of every query's executed plan; flags pairings without keys."""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main() -> None:
    from pyspark.sql import SparkSession

    from voxlode.plans import load_all

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:]
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    for name, q in load_all().items():
        if names and name not in names:
            continue
        plan = q.run(spark, sf)._jdf.queryExecution().executedPlan().toString()
        bad = re.findall(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
        nodes = {k: len(re.findall(k, plan)) for k in ("Exchange ", "SortMergeJoin", "BroadcastHashJoin", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "WindowGroupLimit")}
        print("BAD" if bad else "   ", name, {k: v for k, v in nodes.items() if v}, bad or "", flush=True)
        if names:
            print(plan)
    spark.stop()


if __name__ == "__main__":
    main()
