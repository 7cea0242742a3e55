"""Stages that are published once, replies that are asked once, and a flow that goes on where it was cut off."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from voxlode.operators import enrich as N
from voxlode.operators.ledger import Ledger, fingerprint, from_client, from_table
from voxlode.plans import consolidation
from voxlode.session import scratch_path
from voxlode.sources.published import publish, published

SF = "/root/testdata/sf0.001"


def test_publish_replaces_as_a_whole(spark, tmp_path):
    path = f"{tmp_path}/pointer.json"
    assert published(spark, path) is None
    for n in range(3):
        publish(spark, path, {"n": n, "text": "ä"})
        assert published(spark, path) == {"n": n, "text": "ä"}
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["pointer.json"]


def test_fingerprint_ignores_order_only(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "x int, y string")
    one = fingerprint(df)
    assert fingerprint(df.orderBy(F.desc("x")).repartition(3)) == one
    assert len({one, fingerprint(df.distinct()), fingerprint(df.withColumnRenamed("y", "z")), fingerprint(df.fillna("")), fingerprint(df.limit(0))}) == 5


def test_stages_are_built_once(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(10)
    calls = []

    def build(rows):
        calls.append(1)
        return rows.filter("id > 3")

    def run(source, limit):
        ledger = Ledger(spark, root)
        out = ledger.stage("few", build, ledger.source(source), limit=limit)
        return ledger.built, out.rows.count()

    assert run(df, 1) == (["few"], 6)
    assert run(df.repartition(2), 1) == ([], 6)
    assert run(df, 2) == (["few"], 6)
    assert run(spark.range(5), 1) == (["few"], 1)
    assert len(calls) == 3


def test_an_unpublished_output_does_not_count(spark, tmp_path, monkeypatch):
    """Cut off between writing and publishing: the next run builds the stage again and finds no half of it."""
    from voxlode.operators import ledger as L

    def fail(*_):
        raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        m.setattr(L, "publish", fail)
        one = Ledger(spark, str(tmp_path))
        with pytest.raises(RuntimeError):
            one.stage("s", lambda r: r, one.source(spark.range(3)))
    two = Ledger(spark, str(tmp_path))
    assert two.stage("s", lambda r: r, two.source(spark.range(3))).rows.count() == 3 and two.built == ["s"]


class Counting:
    """A client that writes down what it was asked, and fails on some prompts."""

    def __init__(self, log, fail=""):
        self.log, self.fail = log, fail

    def __call__(self, prompts):
        with open(self.log, "a") as f:
            f.writelines(json.dumps(p) + "\n" for p in prompts)
        return [(None if self.fail and self.fail in p else p.upper(), 1, 1) for p in prompts]


def test_prompts_are_asked_once(spark, tmp_path):
    log = str(tmp_path / "log")
    Path(log).touch()
    prompts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "bad")], "id int, prompt string")
    asked = lambda: sorted(json.loads(x) for x in Path(log).read_text().splitlines())
    ledger = Ledger(spark, str(tmp_path / "root"))
    got = ledger.replies("s", prompts, from_client(lambda: Counting(log, "bad"), 2, tries=1, pause=0.0))
    assert sorted((r.id, r.reply) for r in got.collect()) == [(1, "A"), (2, "B"), (3, "A"), (4, None)]
    assert asked() == ["a", "b", "bad"]
    more = prompts.unionByName(spark.createDataFrame([(5, "c"), (6, "b")], prompts.schema))
    got = Ledger(spark, str(tmp_path / "root")).replies("s", more, from_client(lambda: Counting(log), 2, pause=0.0))
    assert sorted((r.id, r.reply) for r in got.collect()) == [(1, "A"), (2, "B"), (3, "A"), (4, "BAD"), (5, "C"), (6, "B")]
    assert asked() == ["a", "b", "bad", "bad", "c"]


def test_replies_from_a_table(spark, tmp_path):
    prompts = spark.createDataFrame([("x", "a"), ("y", "b")], "id string, prompt string")
    table = spark.createDataFrame([("x", "yes"), ("z", "no")], "id string, reply string")
    got = Ledger(spark, str(tmp_path)).replies("s", prompts, from_table({"s": table}))
    assert sorted(tuple(r) for r in got.collect()) == [("x", "yes"), ("y", None)]


@pytest.mark.skipif(not Path(SF).is_dir(), reason="test tables are not here")
def test_the_flow_goes_on_where_it_was_cut_off(spark, monkeypatch):
    root = scratch_path(spark, "flow")
    with monkeypatch.context() as m:
        m.setattr(consolidation, "refined", lambda *_: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(RuntimeError):
            consolidation.flow(spark, SF, root)
    asked = []
    real = consolidation.from_table

    def watched(tables):
        ask = real(tables)
        return lambda name, rows, store: (asked.append((name, rows.count())), ask(name, rows, store))

    monkeypatch.setattr(consolidation, "from_table", watched)
    ledger, needs, evidence = consolidation.flow(spark, SF, root)
    assert ledger.built == ["refine", "score", "evidence"] and [a for a, _ in asked] == ["refine"]
    again, same, _ = consolidation.flow(spark, SF, root)
    assert again.built == [] and len(asked) == 1
    assert fingerprint(same) == fingerprint(needs) and evidence.count() > 0


def test_composed_texts(spark):
    row = spark.createDataFrame([("T", None, "d" * 200, "app", "", "need")], "title string, semantic_fingerprint string, description string, atom_product string, feature string, need_statement string")
    one = row.select(consolidation.embedding_text().alias("c"), consolidation.atom_text().alias("a")).first()
    assert one.c == "T |  | " + "d" * 120 and one.a == "[app] : need"


def test_a_slow_reply_delays_its_own_rows_only(spark, tmp_path):
    """Calls of a task are in flight together; the others' replies come first."""
    import time

    class Slow:
        def __call__(self, prompts):
            time.sleep(3 if "slow" in prompts else 0.05)
            return [(p, 1, 1) for p in prompts]

    prompts = spark.createDataFrame([(i, "slow" if i == 0 else f"p{i}") for i in range(40)], "id int, prompt string")
    start = time.time()
    got = N.infer_batches(prompts, "id", "prompt", Slow, 1, batch=1, in_flight=8)
    assert got.count() == 40 and {r.id: r.reply for r in got.collect()}[0] == "slow"
    assert time.time() - start < 60
