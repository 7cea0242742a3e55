"""Time the headline queries.  Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "demand_report",
    "quality_funnel",
    "clean_html",
    "top_terms",
    "match_rules",
    "relevance_score",
    "distribution_long_star",
    "product_coverage",
    "top_evidence_star",
    "rank_and_number_star",
    "weighted_avg",
    "match_text_rows",
    "tiered_lookup",
    "similar_pairs",
    "nearest_match",
    "connected_components",
    "average_linkage",
    "top_evidence",
    "dedupe_first",
    "flatten_feed",
    "infer_batches",
    "merge_increment",
    "list_needs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from voxlode.plans import load_all

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("voxlode-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = load_all()
    # Start the JVM's and Python's workers before the clock runs.
    spark.range(100_000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*")).write.format("noop").mode("overwrite").save()
    spark.range(1000).mapInPandas(lambda it: it, "id long").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        found[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
