"""The registered queries beside their SQL, and the pipeline beside brute force."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from tests.llm.test_operators import brute_components, brute_leaks, brute_repeats
from tools.check_oracle import duck, rows_of
from voxlode.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    cur = duck(SF).execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = queries.given(spark, SF, "documents")
    columns = docs.columns
    held = {r.doc_id: r for r in docs.collect()}
    items = [tuple(r) for r in queries.given(spark, SF, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        before = sorted((i, r.text) for i, r in held.items())
        if name != "bpe":
            assert out.columns == columns
            held = {r.doc_id: r for r in out.collect()}
            docs = out
        if name == "near_copies":
            assert set(held) == {i for (i, _, c) in brute_components(before, 80, 5) if i == c}
        elif name == "suffix_dedup":
            gone = {k[0]: k[1] - k[2] for k in brute_repeats(before, 100)}
            assert set(held) == set(gone)
            assert all(0 <= gone[i] - len((r.text or "").encode()) <= 8 for i, r in held.items())
            assert all(r.n_chars == len(r.text) for r in held.values())
        elif name == "decontamination":
            assert set(held) == {k[0] for k in brute_leaks(before, items, 10) if not k[-1]}
        elif name == "bpe":
            assert {r.doc_id for r in out.collect()} == set(held)
    assert 0 < len(held) < 200


def test_workers_get_the_package(tmp_path):
    """A driver in another folder whose workers don't find the package: the first query of a session and a pipeline stage."""
    root = Path(__file__).resolve().parents[2]
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
import __spark_entry__ as e
import corpus_pipeline
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
assert e.queries()["op13_vector_codes"](spark, {SF!r}).count() > 0
docs = spark.read.parquet({SF!r} + "/documents.parquet")
assert dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, {SF!r}).count() > 0
print("fine")
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]
