"""Sources, enrichment jobs, increments, streams and serving on files written by the tests."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from voxlode.operators import enrich as N
from voxlode.operators import serving as V
from voxlode.plans import bindings as B
from voxlode.sources import containers as K
from voxlode.sources import current, feeds, pages, reports, sinks
from voxlode.streaming import increments as L


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


# ---------------------------------------------------------------- sources


def test_read_container_multi_line(spark, tmp_path):
    put(tmp_path / "chat_20260401.json", {"category": "c", "crawl_date": "2026-04-01", "reviews": [{"content": "a", "rating": 1}, {"content": "b"}]})
    put(tmp_path / "social_20260401.json", {"category": "s", "crawl_date": "2026-04-02", "reviews": []})
    rows = K.read_container(spark, f"{tmp_path}/*.json", "reviews", K.REVIEW).select("category", "file_name", "content", "rating")
    assert sorted((r.category, r.file_name, r.content, r.rating) for r in rows.collect()) == [
        ("c", "chat_20260401.json", "a", 1), ("c", "chat_20260401.json", "b", None)]


def test_payload_keys_counts_and_files(spark, tmp_path):
    put(tmp_path / "a_1.json", {"comments": [{"id": "1"}, {"id": "2"}]})
    put(tmp_path / "a_2.json", [{"id": "3"}])
    put(tmp_path / "a_3.json", {"total_reviews": 41})
    put(tmp_path / "a_4.json", {"items": [{"id": "4"}], "data": [{"id": "x"}]})
    put(tmp_path / "a_5.json", "not json")
    put(tmp_path / "b_1.json", {"reviews": [{"id": "5"}]})
    texts = K.discover_files(spark, str(tmp_path), "a_")
    assert sorted(r.id for r in K.explode_any_key(texts, "id string, content string").collect()) == ["1", "2", "3", "4"]
    counts = {r.file_name: r["rows"] for r in K.count_payload(texts).collect()}
    assert counts == {"a_1.json": 2, "a_2.json": 1, "a_3.json": 41, "a_4.json": 1, "a_5.json": 0}
    files = K.count_payload(texts.withColumn("source", F.lit("forum")))
    stats = {r.source: (r["rows"], r.files) for r in K.channel_stats(files, "source", "file_name", "modified", "rows", "2026-04-24").collect()}
    assert stats == {"forum": (45, 5), None: (45, 5)}


def test_unify_sources_prefers_filled_fields(spark):
    a = spark.createDataFrame([("", "t1", None), ("c2", "t2", "5")], "content string, text string, rating string")
    b = spark.createDataFrame([("s1", "3"), ("  ", "1")], "summary string, score string")
    m = {"content": ["content", "text", "summary"], "rating": ["rating", "score"]}
    u = K.unify_sources([K.unify_source(a, m, {"source": "a"}), K.unify_source(b, m)])
    assert sorted((r.content, r.rating, r.source) for r in u.collect()) == [("c2", "5", "a"), ("s1", "3", None), ("t1", None, "a")]


def test_feed_defaults_and_bad_payloads(spark):
    good = {"feed": {"entry": [{"title": {"label": "the app"}}, {"im:rating": {"label": "4"}, "content": {"label": "ok"}}]}}
    df = spark.createDataFrame([("9", json.dumps(good)), ("9", "broken {"), ("9", "{}")], "app_id string, payload string")
    rows = feeds.flatten_feed(df, "store_rss").collect()
    assert [(r.rating, r.content, r.author, r.url) for r in rows] == [(4, "ok", "", "https://apps.apple.com/us/app/id9?see-all=reviews")]
    posts = spark.createDataFrame([(json.dumps({"data": {"children": [{"data": {"id": "p", "created_utc": 86400, "permalink": "/r/x"}}]}}),)], "payload string")
    r = feeds.flatten_feed(posts, "listing_posts").first()
    assert (r.author, r.date, r.source_url, r.score) == ("[deleted]", "1970-01-02T00:00:00", "https://reddit.com/r/x", 0)
    hits = spark.createDataFrame([(json.dumps({"hits": [{"objectID": "7", "comment_text": "<p>a\n  b</p>"}, {"objectID": "8"}]}),)], "payload string")
    assert [(r.author, r.content) for r in feeds.flatten_feed(hits, "forum_hits").collect()] == [("anonymous", "a b"), ("anonymous", "")]


def test_blocks_and_links_and_state(spark):
    html = '<div class="c">long <b>body</b>\ntext</div><p class="r">short</p><p class="r">a long enough reply</p><a href="/t/1">One</a><a href="/t/2"> </a>'
    df = spark.createDataFrame([(1, html)], "id int, html string")
    b = df.select(pages.extract_blocks("html", '<div class="c">(.*?)</div>', '<p class="r">(.*?)</p>', body_chars=8).alias("b")).first().b
    assert (b.content, b.replies) == ("long bod", ["a long enough reply"])
    found = pages.extract_links(df, "html", r'<a href="(/t/\d+)">([^<]*)</a>', 5, base="https://x.org", drop_empty=True).collect()
    assert [(r.pos, r.href, r.link_text) for r in found] == [(0, "https://x.org/t/1", "One")]
    state = "<script>window.STATE = " + json.dumps({"search": {"notes": {"items": [{"note": {"id": "n1", "desc": "d"}}]}}}) + "</script>"
    s = spark.createDataFrame([(1, state), (2, "<p>none</p>")], "id int, html string")
    assert [(r.id, r.content) for r in pages.extract_embedded_json(s, "html", r"window\.STATE\s*=\s*(\{.+?\})</script>").drop("id").withColumnRenamed("source_url", "u").select(F.substring_index("u", "/", -1).alias("id"), "content").collect()] == [("n1", "d")]


@pytest.mark.parametrize("fmt", [reports.DEFAULT, reports.CHINESE])
def test_report_round_trip(spark, tmp_path, fmt):
    stats = spark.createDataFrame(
        [("a", "功能需求", "Find it", 12, 7, "x、y", 1), ("b", "问题反馈", "Fix it", 3, 2, "z", 2)], "d string, section string, title string, mentions int, ai_score int, direction string, rank int")
    samples = spark.createDataFrame([("a", "one\ntext", 1, 1), ("a", "t" * 300, 5, 2), ("b", "other", 3, 3)], "d string, text string, rating int, o int")
    lines = reports.report_lines(stats, samples, "d", "text", "rating", [F.col("o")], fmt)
    path = str(tmp_path / f"r{len(fmt.mentions)}{fmt.quote_open == '“'}")
    reports.write_report(lines, path)
    demands, quoted = reports.parse_ranked_report(spark, path, fmt)
    got = sorted((r.section, r.title, r.mention_count, r.ai_score, r.keywords) for r in demands.collect())
    assert got == [("功能需求", "Find it", 12, 7, ["x", "y"]), ("问题反馈", "Fix it", 3, 2, ["z"])]
    assert sorted((r.title, r.idx, r.rating, r.content) for r in quoted.collect()) == [
        ("Find it", 1, 1, "one text"), ("Find it", 2, 5, "t" * 250 + "..."), ("Fix it", 1, 3, "other")]


def test_snapshots_keep_history(spark, tmp_path):
    path = str(tmp_path / "list")
    sinks.write_snapshot(spark.range(3), path, "2026-01-01")
    sinks.write_snapshot(spark.range(5), path, "2026-01-08")
    every = sinks.read_snapshots(spark, path)
    assert {r.status for r in sinks.snapshot_as_of(every, "2026-01-01").collect()} == {"ok"}
    stale = sinks.snapshot_as_of(every, "2026-01-05")
    assert stale.count() == 5 and stale.first().status == "stale"
    assert sinks.snapshot_up_to(every, "2026-01-05").count() == 3
    with pytest.raises(Exception, match="exists"):
        sinks.write_snapshot(spark.range(1), path, "2026-01-08")
    with pytest.raises(ValueError):
        sinks.write_snapshot(spark.range(1), path, "../x")


# ---------------------------------------------------------------- enrichment


def test_parse_atoms_edges(spark):
    replies = ['{"atoms":[{"need_statement":" a "},{"x":1},{"need_statement":"b","sentiment":"angry"}]}', '{"atoms":[]}', '{"atoms":[{"need', "[1]", "plain", None, '{"atoms":"no"}']
    df = spark.createDataFrame([(i, r, "p") for i, r in enumerate(replies)], "id int, reply string, product string")
    got = [(r.atom_id, r.need_statement, r.sentiment, r.atom_product) for r in N.parse_atoms(df, "id", "reply", "product").collect()]
    assert got == [("0_a1", "a", "neutral", "p"), ("0_a3", "b", "angry", "p")]


def test_strip_fences(spark):
    rows = ['```json\n{"k": 1}\n```', 'text ```\n{"k": 2}\n``` more', '{"k": 3}', '{"k":', "[4]", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, r string")
    got = [(r.p.value.k if r.p.value else None, r.p.error) for r in df.select("i", N.parsed_or_error("r", "k int").alias("p")).orderBy("i").collect()]
    assert got == [(1, None), (2, None), (3, None), (None, "no JSON object"), (None, "no JSON object"), (None, "no JSON object")]


def test_prompt_braces_in_values_stay(spark):
    df = spark.createDataFrame([("{b}", None)], "a string, b string")
    assert df.select(N.render_prompt("x {a} {b} {c}", {"a": F.col("a"), "b": F.col("b")}).alias("p")).first().p == "x {b}  {c}"


class CountingClient:
    """Appends each prompt to a file, so that calls can be counted over processes; one prompt always fails."""

    def __init__(self, path):
        self.path = path

    def __call__(self, prompts):
        with open(self.path, "a") as f:
            f.writelines(p + "\n" for p in prompts)
        if any("boom" in p for p in prompts):
            raise RuntimeError("boom")
        return [("r:" + p, 1, 2) for p in prompts]


def test_replies_are_paid_once_and_resumed(spark, tmp_path):
    log, path = str(tmp_path / "calls"), str(tmp_path / "replies")
    todo = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "id long, prompt string")
    out = N.infer_batches(todo.filter("id < 12"), "id", "prompt", lambda: CountingClient(log), 3, path, batch=4)
    # Reading the replies again and again asks nobody.
    assert out.count() == 12 and out.filter("reply is null").count() == 0 and out.agg(F.sum("completion_tokens")).first()[0] == 24
    again = N.resume_infer(todo, "id", "prompt", lambda: CountingClient(log), 3, path, batch=4)
    assert again.count() == 20
    assert sorted(open(log).read().split()) == sorted(f"p{i}" for i in range(20))


def test_failed_batches_give_null_replies(spark, tmp_path):
    todo = spark.createDataFrame([(1, "boom"), (2, "fine")], "id long, prompt string")
    log = str(tmp_path / "calls")
    out = N.infer_batches(todo, "id", "prompt", lambda: CountingClient(log), 1, batch=1, tries=3, pause=0.0)
    assert {r.id: r.reply for r in out.collect()} == {1: None, 2: "r:fine"}
    assert open(log).read().split().count("boom") == 3
    cost = N.usage(out.withColumn("n", F.when(F.col("reply").isNotNull(), 1).otherwise(0)), "n").first()
    assert (cost.rows, cost.empty_or_failed, cost.prompt_tokens) == (2, 1, 1)


def test_fallback_clients():
    ask = N.with_fallback([B.LineClient("a:", fail="x"), B.LineClient("b:")])
    assert [r[0] for r in ask(["x1", "y1"])] == ["b:x1", "a:y1"]


def test_overlapping_batches_bounds(spark):
    df = spark.range(7).withColumn("g", F.lit("g"))
    rows = N.overlapping_batches(df, ["g"], [F.col("id")], 4).collect()
    got: dict = {}
    for r in rows:
        got.setdefault(r.batch, []).append((r.local, r.id))
    # The shifted window of one row (6) is left out.
    assert {k: [i for _, i in sorted(v)] for k, v in got.items()} == {"a0": [0, 1, 2, 3], "a1": [4, 5, 6], "b0": [2, 3, 4, 5]}


def test_translate_missing(spark):
    c = spark.createDataFrame([(1, "hello there", True), (2, "der old", True), (3, "bad", False), (4, "done", True)], "id long, content string, ok boolean")
    done = spark.createDataFrame([(4, "é done")], "id long, content_zh string")
    out, counts = N.translate_missing(c, done, F.col("ok"), F.lit(True), lambda: B.LineClient("é ", fail="der"), 2, "À-ÿ")
    assert {r.id: (r.content_out, r.has_translation) for r in out.collect()} == {1: ("é hello there", True), 2: ("der old", False), 4: ("é done", True)}
    r = counts.first()
    assert (r.asked, r.translated, r.failed) == (2, 1, 1)


def test_embeddings(spark):
    df = spark.createDataFrame([(1, "alpha beta"), (2, "alpha beta"), (3, "zzz qqq")], "id int, t string")
    v = {r.id: r.v for r in N.embed_text_tfidf(df, "t", "v", dims=64).collect()}
    assert v[1] == pytest.approx(v[2]) and sum(x * x for x in v[1]) == pytest.approx(1.0)
    w = N.embed_text_client(df, "t", "v", lambda: lambda ts: [[float(len(t))] for t in ts], batch=2)
    assert {r.id: r.v for r in w.collect()} == {1: [10.0], 2: [10.0], 3: [7.0]}


# ---------------------------------------------------------------- increments


MAIN = "id string, category string, vec array<double>, mention_count long, is_new boolean, discovered_at string, last_updated_at string, priority string, title string"


def _main(spark):
    return spark.createDataFrame([("m1", "c", [1.0, 0.0], 5, False, "2026-01-01", None, "P0", "one"), ("m2", "c", [0.0, 1.0], 7, True, "2026-04-01", None, "P2", "two")], MAIN)


def _new(spark):
    return spark.createDataFrame([(1, "c", [1.0, 0.1], 2, "n1"), (2, "c", [1.0, 0.2], 3, "n2"), (3, "c", [0.7, 0.7], 4, "n3"), (4, "c", [0.7, 0.7], 1, "n4")], "ord long, category string, vec array<double>, size long, title string")


WANT = [("c_demand_new_2026-04-24_3", 4, True, None, "P1"), ("c_demand_new_2026-04-24_4", 1, True, None, "P1"), ("m1", 10, False, "2026-04-24", "P0"), ("m2", 7, True, None, "P2")]


def _shape(df):
    return sorted((r.id, r.mention_count, r.is_new, r.last_updated_at, r.priority) for r in df.collect())


def test_merge_increment_stays_in_its_category(spark):
    new = spark.createDataFrame([(1, "other", [1.0, 0.0], 3, "n1")], "ord long, category string, vec array<double>, size long, title string")
    assert ("m1", 5, False, None, "P0") in _shape(L.merge_increment(_main(spark), new, "vec", "2026-04-24"))


def test_merge_increment(spark):
    # New rows are not compared with each other: the two equal ones both stay.
    assert _shape(L.merge_increment(_main(spark), _new(spark), "vec", "2026-04-24")) == WANT
    assert _shape(L.merge_increment(_main(spark), _new(spark).filter("ord > 9"), "vec", "2026-04-24"))[0][:2] == ("m1", 5)
    assert L.merge_increment(_main(spark).filter("id = 'x'"), _new(spark), "vec", "2026-04-24").count() == 4


def test_merge_stream_equals_batch_and_survives_a_rerun(spark, tmp_path):
    _main(spark).write.parquet(f"{tmp_path}/list/snapshot=0000")
    _new(spark).repartition(1).write.parquet(f"{tmp_path}/landed")

    def run(checkpoint):
        stream = L.landed_stream(spark, f"{tmp_path}/landed", _new(spark).schema, "parquet")
        L.merge_stream(stream, f"{tmp_path}/list", f"{tmp_path}/{checkpoint}", lambda m, b: L.merge_increment(m, b, "vec", "2026-04-24"), lambda e: f"{e + 1:04d}").awaitTermination()
        return _shape(spark.read.parquet(f"{tmp_path}/list/snapshot=0001"))

    assert run("cp1") == WANT
    # The same batch again (its progress was lost) replaces its own snapshot instead of adding twice.
    assert run("cp2") == WANT


def test_a_list_is_replaced_by_category(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "list")
    rows = lambda *r: spark.createDataFrame(list(r), "id int, category string, n int")
    with pytest.raises(ValueError):
        current.read_list(spark, path)
    current.write_list(rows((1, "a", 1), (2, "b", 1), (3, None, 1)), path, "v1")
    shown = lambda **k: sorted(tuple(r) for r in current.read_list(spark, path, **k).collect())
    assert shown() == [(1, "a", 1), (2, "b", 1), (3, None, 1)]
    with monkeypatch.context() as m:
        m.setattr(current, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(RuntimeError):
            current.write_list(rows((1, "a", 5)), path, "v2", touched=["a"])
    assert shown() == [(1, "a", 1), (2, "b", 1), (3, None, 1)] and current.current_version(spark, path) == "v1"
    current.write_list(rows((1, "a", 2), (4, "a", 2)), path, "v2", touched=["a", "gone"])
    assert shown() == [(1, "a", 2), (2, "b", 1), (3, None, 1), (4, "a", 2)]
    assert shown(only=[None, "a"]) == [(1, "a", 2), (3, None, 1), (4, "a", 2)] and shown(version="v1") == [(1, "a", 1), (2, "b", 1), (3, None, 1)]
    one, two = (dict((c, f) for c, f in current.manifest_of(spark, path, v)["categories"]) for v in ("v1", "v2"))
    assert one["b"] == two["b"] and one[None] == two[None] and one["a"] != two["a"]
    current.write_list(rows(), path, "v3", touched=["b"])
    assert shown() == [(1, "a", 2), (3, None, 1), (4, "a", 2)]
    with pytest.raises(ValueError):
        current.write_list(spark.range(1).selectExpr("id", "'a' AS category"), path, "v4", touched=["a"])


def test_merge_list_stream_writes_what_it_touches(spark, tmp_path):
    path = f"{tmp_path}/list"
    current.write_list(_main(spark).unionByName(_main(spark).selectExpr("concat('z', id) AS id", "vec", "'z' AS category", *[c for c in _main(spark).columns if c not in ("id", "vec", "category")])), path, "0000")
    before = current.manifest_of(spark, path)
    _new(spark).repartition(1).write.parquet(f"{tmp_path}/landed")

    def run(checkpoint):
        stream = L.landed_stream(spark, f"{tmp_path}/landed", _new(spark).schema, "parquet")
        L.merge_list_stream(stream, path, f"{tmp_path}/{checkpoint}", lambda m, b: L.merge_increment(m, b, "vec", "2026-04-24"), lambda e: f"{e + 1:04d}").awaitTermination()
        return _shape(current.read_list(spark, path).filter("category <> 'z'"))

    assert run("cp1") == WANT
    # The same batch again starts from the version before its own.
    assert run("cp2") == WANT
    after = current.manifest_of(spark, path)
    assert after["version"] == "0001" and after["before"] == "0000"
    assert dict(map(tuple, after["categories"]))["z"] == dict(map(tuple, before["categories"]))["z"]


def test_expire_new(spark):
    rows = [(True, "2026-04-17"), (True, "2026-04-16"), (True, "bad"), (True, ""), (False, "2026-04-24"), (None, "2026-04-24")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, f boolean, d string")
    got = [r.x for r in df.select("i", L.expire_new("f", "d", "2026-04-24").alias("x")).orderBy("i").collect()]
    assert got == [True, False, False, True, False, False]


def test_ingest_takes_new_files_once(spark, tmp_path):
    schema = "id string, date string, category string"

    def land(name, rows):
        put(tmp_path / "in" / name, "\n".join(json.dumps(dict(zip(("id", "date", "category"), r))) for r in rows))

    def run():
        s = L.landed_stream(spark, f"{tmp_path}/in", schema, "json", glob="*.json")
        L.ingest_increment(s, "date", "2026-04-24", 7, f"{tmp_path}/out", f"{tmp_path}/cp", ["category"]).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect())

    land("one.json", [("a", "2026-04-23T10:00:00Z", "x"), ("b", "2026-01-01", "x"), ("c", "bad", "x")])
    assert run() == ["a"]
    land("two.json", [("d", "2026-04-20", "y")])
    assert run() == ["a", "d"]
    assert run() == ["a", "d"]


def test_dedupe_stream_late_copies(spark, tmp_path):
    t0 = datetime(2026, 4, 1)
    rows = [("a", t0), ("b", t0 + timedelta(minutes=1)), ("a", t0 + timedelta(minutes=2))]
    later = [("b", t0 + timedelta(minutes=30)), ("c", t0 + timedelta(minutes=31))]
    for i, part in enumerate((rows, later)):
        spark.createDataFrame(part, "id string, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/in/p{i}")
    stream = spark.readStream.schema("id string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    q = L.dedupe_stream(stream, "id", "ts", "1 hour").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b", "c"]


# ---------------------------------------------------------------- serving


def test_serving_edges(spark):
    schema = ("id string, title string, demand_type string, mention_count int, final_score double, apps array<string>, ai_keywords array<string>, is_cross_product boolean, "
              "source_breakdown map<string,bigint>, product_breakdown map<string,bigint>, evidence array<struct<date:string,app_name:string,channel:string>>")
    ev = [("2026-01-02", "App", "store"), ("2026-03-01", "App", "play"), ("2025-01-01", "Two", "store")]
    rows = [("a", "Dark Mode", "feature", 3, 1.0, ["App"], ["k"] * 6, True, {"play": 1}, {"x: y": 9, "Good": 2, "z" * 31: 5}, ev), ("b", "Other", None, 9, 2.0, [], [], False, {"store": 0}, {"a: b": 1}, ev[:1])]
    df = spark.createDataFrame(rows, schema)
    ids = lambda d: [r.id for r in d.collect()]
    assert ids(V.search(df, "  dark ", ["title"], ["apps"])) == ["a"] and len(ids(V.search(df, " ", ["title"], []))) == 2
    assert ids(V.filter_facets(df, ["play", "store"])) == ["a"] and len(ids(V.filter_facets(df))) == 2
    assert ids(V.filter_facets(df, types=["feature"])) == ["a"] and ids(V.filter_facets(df, only_cross=True)) == ["a"]
    assert ids(V.sort_page(df, "recent")) == ["a", "b"] and ids(V.sort_page(df, "mentions", 1)) == ["b"]
    v = {r.id: r for r in V.need_view(df.withColumn("category", F.lit("c"))).collect()}
    assert v["a"].apps == ["Good"] and len(v["a"].keywords) == 4
    # No usable product name: taken from the evidence.
    assert v["b"].apps == ["App"]
    assert [(s.name, s.n) for s in v["a"].mention_sources] == [("store", 2), ("play", 1)]


def test_keys_of_texts_are_made_once(spark, monkeypatch):
    """Sizes, terms and the merged groups come from one pass over the texts."""
    from voxlode.plans import queries_clustering as Q

    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def terms(t):
        seen.add(1)
        return sorted(set(t.split()))[:5]

    monkeypatch.setattr(Q.text, "top_terms", lambda c, *_: terms(c))
    d = "/root/testdata/sf0.001"
    rows = Q.greedy_merge_clusters(spark, d).collect()
    assert rows and 0 < seen.value <= Q.table(spark, d, "documents").count()


def test_grams_are_counted_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        seen.add(1)
        return "abcabd"[: i % 7]

    rows = spark.range(0, 70, 1, 2).select("id", text("id").alias("t"))
    got = N.embed_text_tfidf(rows, "t", "v", dims=16, carry=["id"])
    assert got.columns == ["id", "v"] and len(got.collect()) == 70
    assert seen.value == 70
