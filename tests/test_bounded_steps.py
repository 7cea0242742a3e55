"""Steps whose rows, candidates or plans must not grow with the length of texts, with hot keys or with rounds."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from voxlode.operators import clustering as C
from voxlode.operators import containment as T
from voxlode.operators import joins as J
from voxlode.operators import ranking as R
from voxlode.operators import similarity as S
from voxlode.streaming import increments as L


def test_long_needles_have_few_keys(spark):
    r = random.Random(4)
    long = "".join(r.choice("abcdefgh ") for _ in range(6000))
    keys = T.needle_keys(spark.createDataFrame([(1, long), (2, long[500:560])], "id long, t string"), "id", "t")
    n = {x["id"]: x["count"] for x in keys.groupBy("id").count().collect()}
    assert n[1] <= T.MOST + 2 and 1 <= n[2] <= T.MOST + 2


def test_containment_by_few_keys(spark):
    """Texts inside and around long ones are found wherever they stand."""
    r = random.Random(5)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(r.choice((3, 20, 200, 3000)))) for _ in range(60)]
    asked = [t[len(t) // 3 :][: r.choice((2, 14, 15, 16, 70, 900))] for t in texts] + ["x" + t + "y" for t in texts[::3]] + ["zz" + texts[1][5:]]
    hay = spark.createDataFrame(list(enumerate(texts)), "r long, text string")
    rest = spark.createDataFrame([x for x in enumerate(asked) if x[1]], "id long, text string")
    got = {(x["id"], x["r"]) for x in T.lowest_contained(rest, hay).collect()}
    want = {(i, min(k)) for i, a in enumerate(asked) if a and (k := [j for j, t in enumerate(texts) if a in t or t in a])}
    assert got == want


def test_lookup_of_titles_with_one_beginning(spark, monkeypatch):
    """All titles and keys begin alike: a title still meets few keys, and gets the first that fits."""
    met, lowest = [], T.lowest_match

    def spy(askers, lists, verify):
        return lowest(askers, lists, lambda pairs: met.append(pairs.count()) or verify(pairs))

    monkeypatch.setattr(T, "lowest_match", spy)
    titles = [f"same start {i:03d} of a title that is long" for i in range(120)] + ["same", "start 007", "", None]
    keys = [f"same start {i:03d} of" for i in range(120)] + ["same start 005 of", "same start 1", "sam", "same start 009 of a title that is long"]
    rows = spark.createDataFrame([(t,) for t in titles], "title string")
    dim = spark.createDataFrame([(k, i, f"p{i}") for i, k in enumerate(keys)], "key string, ord long, plan string")
    got = {(x.title, x.tier, x.plan) for x in J.tiered_lookup(rows, dim, "title", "key", "ord", ["plan"]).collect()}

    def best(t):
        if not t:
            return t, None, None
        fits = [(1 if k == t else 2 if k.replace(" ", "") == t.replace(" ", "") else 3, i) for i, k in enumerate(keys) if k.replace(" ", "") == t.replace(" ", "") or (len(k) >= 4 and (k in t or t in k))]
        return (t, min(fits)[0], f"p{min(fits)[1]}") if fits else (t, None, None)

    assert got == {best(t) for t in titles}
    assert 0 < sum(met) < 120 * 120 / 4


def test_kmeans_plan_does_not_grow_with_rounds(spark):
    x = np.random.default_rng(6).normal(size=(240, 4))
    df = spark.createDataFrame([("ab"[i % 2], i, v.tolist()) for i, v in enumerate(x)], "g string, id long, vec array<double>")
    parts = C.split_oversize(df, "g", "id", "vec", max_size=6, task_rows=20)
    assert parts._jdf.queryExecution().logical().toString().count("LogicalRDD") < 24
    whole = C.split_oversize(df, "g", "id", "vec", max_size=6)
    as_set = lambda d: {(r.id, r.part) for r in d.collect()}
    assert as_set(parts) == as_set(whole)


def test_counted_atoms_carry_no_text(spark):
    """Atoms without statements are the same rows, and no text reaches a join."""
    from voxlode.sources.tables import atoms

    d = "/root/testdata/sf0.001"
    counted, full = atoms(spark, d, statements=False), atoms(spark, d).drop("need_statement")
    assert counted.columns == full.columns
    assert not counted.exceptAll(full).count() and not full.exceptAll(counted).count()
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    top = plan.index("Join")
    assert not [x for x in plan[top:].splitlines() if "Project" in x and "text#" in x.split("size(")[0]]


def test_rows_are_judged_once(spark):
    """What judges the rows of a sample over time, or the fresh evidence made of it, runs once for each row."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def topic(i):
        seen.add(1)
        return f"t{i % 3}"

    day = F.timestamp_seconds(F.lit(1735689600) + F.col("id") * 86400)
    rows = spark.range(0, 300, 1, 4).select("id", topic("id").alias("topic"), F.concat(F.lit("a"), F.col("id") % 7).alias("app"), day.alias("ts"), F.col("id").alias("o"))
    fresh = R.time_stratified_sample(rows, "topic", "id", "app", "ts", "o", F.timestamp_seconds(F.lit(1735689600)), 365)
    old = spark.createDataFrame([("t0", 1), ("gone", 2)], "topic string, row_id long").withColumns({c: F.lit(None) for c in fresh.columns if c not in ("topic", "row_id")})
    got = R.refresh_evidence(old, fresh.select(old.columns), "topic").collect()
    assert seen.value == 300
    assert sorted({r.topic for r in got}) == ["gone", "t0", "t1", "t2"] and sum(r.topic == "t0" for r in got) == 5


def test_length_of_a_vector_is_taken_once(spark):
    rows = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [None, 1.0])], "id long, v array<double>")
    df = rows.select("id", S.unit("v").alias("u"))
    # Taken in the lambda of the components it would be taken for each of them.
    assert df._jdf.queryExecution().analyzed().toString().count("aggregate(") == 1
    assert [r.u for r in df.orderBy("id").collect()] == [[0.6, 0.8], [0.0, 0.0], None, [None, None]]


def test_lists_are_compared_once(spark):
    """The merge of a batch reads its rows for the comparison, and each list once more for what becomes of it."""
    seen = {k: spark.sparkContext.accumulator(0) for k in ("main", "new")}

    def category(name):
        def of(i):
            seen[name].add(1)
            return f"c{i % 2}"

        return F.udf(of, "string")

    vec = F.array(*[F.pmod(F.xxhash64("n", F.lit(k)), F.lit(7)).cast("double") for k in range(4)])
    base = spark.range(0, 40, 1, 2).withColumnRenamed("id", "n")
    main = base.select(
        F.concat(F.lit("m"), F.col("n")).alias("id"), category("main")("n").alias("category"), vec.alias("v"), F.lit(1).cast("long").alias("mention_count"), F.lit(False).alias("is_new"),
        F.lit("d").alias("discovered_at"), F.lit(None).cast("string").alias("last_updated_at"))
    new = base.select((F.col("n") + 100).alias("n")).select(F.col("n").alias("ord"), category("new")("n").alias("category"), vec.alias("v"), F.lit(1).alias("size"))
    out = L.merge_increment(main, new, "v", "2025-01-01", 0.9).collect()
    assert sum(r.mention_count for r in out) == 80
    assert seen["main"].value <= 80 and seen["new"].value <= 120
