"""Text, date, quality and score functions on literal rows, with the edges of every rule."""

from __future__ import annotations

import html
import re

import pytest
from pyspark.sql import functions as F

from voxlode.functions import dates, quality, scores, text
from voxlode.functions.quality import QualityRules, SampleRules
from voxlode.lexicon import Rule
from voxlode.operators import tagging


def one(spark, column, **values):
    """Value of a column over one literal row."""
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


def column_values(spark, rows, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c string")
    return [r.x for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def test_clean_html_equals_plain_rules(spark):
    rows = ["<p>a &amp; b</p>\n <i>c</i>", "&lt;b&gt;x&lt;/b&gt;", "&amp;quot;q&amp;quot;", "x&#x27;y &copy; &eacute;", "plain", "", None, "a　b"]

    def want(s):
        s = s or ""
        for k, v in text.ENTITIES.items():
            s = s.replace(k, v)
        s = re.sub(r"<[^>]+>", " ", html.unescape(s))
        return re.sub(r"\s+", " ", s).strip()

    assert column_values(spark, rows, text.clean_html("c")) == [want(r) for r in rows]


def test_clean_html_keeps_or_drops_script_text(spark):
    rows = ["<script>var a=1;</script>t", "<style>p{}</style>t"]
    assert column_values(spark, rows, text.clean_html("c")) == ["var a=1; t", "p{} t"]
    assert column_values(spark, rows, text.clean_html("c", drop_code=True)) == ["t", "t"]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_parse_ts_does_not_depend_on_the_session_zone(spark, zone):
    rows = ["2026-04-21T22:55:35-07:00", "2026-04-22T05:55:35Z", "2026-04-22", "2026-04-22 05:55", "2026-04-22T05:55:35+0000", "", "22:55", "2026", "n/a", None]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = column_values(spark, rows, dates.parse_ts("c").cast("bigint"))
        day = column_values(spark, rows, dates.day_label("c"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1776837335, 1776837335, 1776816000, 1776837300, 1776837335, None, None, None, None, None]
    # The label is the local day as written.
    assert day[:3] == ["2026-04-21", "2026-04-22", "2026-04-22"] and day[5:] == [None] * 5


def test_format_date_multi(spark):
    rows = ["2026-04-21T22:55:35-07:00", "2026-04-21", "2026/04/21", "21/04/2026", "31/02/2026", "garbage text", "short", "", None, "2026-04-21 10:00"]
    got = column_values(spark, rows, dates.format_date_multi("c"))
    assert got == ["2026-04-21", "2026-04-21", "2026-04-21", "2026-04-21", "31/02/2026", "garbage te", "short", "", "", "2026-04-21"]


def test_recent_only_null_policy(spark):
    rows = ["2024-06-30T00:00:00Z", "2024-06-29T23:59:59Z", "2024-06-29T23:00:00-07:00", "bad", None]
    assert column_values(spark, rows, dates.recent_only("c", "2024-06-30")) == [True, False, True, False, False]
    assert column_values(spark, rows, dates.recent_only("c", "2024-06-30", True)) == [True, False, True, True, True]


def test_symbols_and_keys(spark):
    assert column_values(spark, ["a\U0001F600b\r\nc ", None], text.strip_symbols("c")) == ["ab  c", ""]
    assert column_values(spark, ["  x\ny" + "z" * 60], text.content_key("c")) == ["x y" + "z" * 47]
    assert column_values(spark, ["x" * 5, "x" * 6, "a\nb"], text.truncate("c", 5)) == ["x" * 5, "x" * 5 + "...", "a b"]


def test_top_terms_ties_by_first_place(spark):
    rows = ["bb aa aa bb cc dd dd dd", "", "x", None]
    assert column_values(spark, rows, text.top_terms("c", "[a-z]{2,}", 3)) == [["dd", "bb", "aa"], [], [], []]


def test_normalize_statement_examples(spark):
    form = text.StatementForm(
        prefix="Users suggest", opener=r"(?:users|the author|i|we)?\s*(?:hope|suggest|want|ask)(?:,|:)?", modal=r"(?:should|must|needs to)",
        subject=r"[A-Za-z][A-Za-z\s]{0,20}?", subject_modal=r"should|must|can", generic_subjects=["AI", "app", "the app"],
    )
    rows = ["AI should keep  context", "we hope for filters", "should have dark mode", "group chat should fold", "bad ranking", "", None]
    assert column_values(spark, rows, text.normalize_statement("c", form)) == [
        "Users suggest keep context", "Users suggest for filters", "Users suggest have dark mode", "Users suggest group chat fold", "Users suggest:bad ranking", "", "",
    ]


def test_split_source(spark):
    rows = ["Store - App - two", "Forum - [dead]", "Forum"]
    got = column_values(spark, rows, text.split_source("c"))
    assert [(r.platform, r.label) for r in got] == [("Store", "App - two"), ("Forum", None), ("Forum", None)]


RULES = QualityRules(
    reject=[("stub", r"^[^\n]{0,15}$"), ("repeat", r"([^\n])\1{5,}")], incoherent=[r"why\?", r"what\?"], indicators=["hope", "always", "slow", "work", "fix"], term=r"[a-z]{3,}"
)


@pytest.mark.parametrize(
    "value,score,reason",
    [
        ("x" * 3, 0.0, "too_short"),
        ("abcdefghi " + "b" * 9, 0.0, "too_short"),
        ("abcdefghi jklmnopqrs", 3.0, "hq=0"),
        ("abcdefghi jklmnopqrs tuvwxyz a", 5.0, "hq=0"),
        ("abcdefghi " * 5, 6.0, "hq=0"),
        ("abcdefghi " * 10, 7.0, "hq=0"),
        ("I hope it is all fine by tomorrow", 5.5, "hq=1"),
        ("I hope this works always when slow", 7.0, "hq=4"),
        ("hope always slow work fix and more hope", 7.0, "hq=5"),
        ("aaaaaa is repeated six times here", 0.0, "low_quality_pattern:repeat"),
        ("Is this it? Really bad? Oh my god? no", 0.0, "incoherent"),
    ],
)
def test_assess_quality_edges(spark, value, score, reason):
    df = spark.createDataFrame([(value,)], "t string")
    r = quality.assess_quality(df, "t", RULES).first()
    assert (r.quality_score, r.quality_reason, r.keep) == (score, reason, score >= 2)


def test_incoherent_questions_half_is_fine_more_is_not(spark):
    rows = ["same part here. same part here? same part here. same part here?", "alpha beta one. alpha beta two. alpha beta three. alpha beta four",
            "alpha beta. gamma delta. epsilon zeta. theta iota", "one? two? tre? four?"]
    # Two questions in four sentences are half; the first and third text fail on disjoint terms.
    got = column_values(spark, rows, quality.is_incoherent("c", RULES))
    assert got == [False, False, True, True]


def test_low_quality_comment_rules(spark):
    rows = ["x" * 29, "https://example.org/a/very/long/path/here", "THIS IS ALL SHOUTING AND IT IS SHORT", "a normal comment with enough letters in it",
            "!!!!????....,,,,;;;;::::----++++abc", "aaaaaaa repeated letters in a comment of length", None, "THIS SHOUTING IS LONGER THAN SIXTY CHARACTERS SO IT PASSES THE RULE"]
    assert column_values(spark, rows, quality.is_low_quality_comment("c", ["ok"])) == [True, True, True, False, True, True, True, False]


def test_civil_information_relevance(spark):
    rude, hot = ["idiot"], [r"trash", r"!{3,}"]
    rows = ["you IDIOT", "trash", "this is trash and trash but I can explain it well", "trash!!! trash!!! and a longer explanation follows", "fine"]
    assert column_values(spark, rows, quality.is_civil("c", rude, hot)) == [False, False, True, False, True]
    rows = ["abcdefghij klmnopqrs tuvwxyz ab", "a" * 40, "x" * 29, "abcdefghij " * 28]
    assert column_values(spark, rows, quality.has_information("c")) == [True, False, False, False]
    rows = ["slow and crash", "slow slow", "slow", "slow " + "x" * 60, "SLOW Crash"]
    assert column_values(spark, rows, quality.is_strongly_relevant("c", ["slow", "crash"])) == [True, True, False, True, True]


def test_low_rating_and_topic(spark):
    df = spark.createDataFrame([(None,), (0,), (3,), (4,)], "r int")
    assert df.filter(quality.low_rating("r")).count() == 3
    rows = spark.createDataFrame([("a", "forum", "x ai y"), ("a", "forum", "none"), ("b", "forum", "none"), ("z", "forum", "ai"), ("a", "store", "none")], "c string, s string, t string")
    keep = quality.on_topic("c", "s", F.col("t"), {"a": ["AI"]}, "forum", ["z"])
    assert [r.c + r.s + r.t for r in rows.filter(keep).collect()] == ["aforumx ai y", "bforumnone", "astorenone"]


def test_sample_quality_clamps(spark):
    s = SampleRules(structure=[(["I"], ["want"])], negative=["bad", "sad", "mad"], scenario=["open"])
    value = "I want to open the export, always hope it will work fix slow, export export"
    got = one(spark, quality.sample_quality("t", F.lit(True), ["export"], ["open", "work", "hope"], RULES, s), t=value)
    assert got == 10.0
    assert one(spark, quality.sample_quality("t", F.lit(False), ["export"], [], RULES, s), t=value) == 0.0


def test_scores_edges(spark):
    def importance(size, w, dist, tier):
        df = spark.createDataFrame([(size, w, dist, tier)], "size int, w double, d map<string,bigint>, tier int")
        return df.select(F.round(scores.importance_score("size", "w", scores.mean_intensity("d"), "tier"), 4).alias("x")).first().x

    assert importance(0, 5.0, {}, 2) == 0.0
    assert importance(1, 3.0, {"neutral": 1}, 3) == pytest.approx(1.0397 + 1 + 0.15 - 0.5, abs=1e-3)
    assert importance(300, 1.0, {"angry": 3, "odd": 1}, 1) == pytest.approx(6 + 2 + 1.5 * (3.5 / 4) + 0.5, abs=1e-3)
    ai = spark.createDataFrame([(6,), (7,), (10,)], "a int").select(scores.ai_relevance_score("a").alias("x")).collect()
    assert [r.x for r in ai] == [6.0, 7.5, 10.0]
    pts = spark.createDataFrame([(None,), (0,), (39,), (40,), (41,)], "p int").select(scores.vote_weight("p").alias("x")).collect()
    assert [r.x for r in pts] == [1.0, 1.0, 4.9, 5.0, 5.0]


@pytest.mark.parametrize(
    "products,want",
    [
        ({}, (1.0, 0, False, False)),
        ({"a": 4, "b": 1, "c": 1, "d": 1, "e": 1, "f": 1, "g": 1}, (0.4, 7, False, True)),
        ({"a": 3, "b": 1, "c": 1, "d": 1, "e": 1, "f": 1, "g": 1}, (1 / 3, 7, True, True)),
        ({"a": 2, "b": 1, "c": 1, "d": 1, "e": 1, "f": 1}, (2 / 7, 6, False, True)),
        ({"a": 7, "b": 2, "c": 1}, (0.7, 3, False, False)),
        ({"a": 1, "b": 1}, (0.5, 2, False, False)),
    ],
)
def test_product_coverage_thresholds(spark, products, want):
    df = spark.createDataFrame([(products,)], "p map<string,bigint>")
    r = df.select(scores.product_coverage("p").alias("c")).first().c
    assert (r.top_share, r.product_count, r.dirty, r.cross_product) == pytest.approx(want)


def test_relevance_score_by_hand(spark):
    rule = Rule("r", keywords=("slow", "lag"), context=("video",))
    words = tagging.RelevanceWords(negative=["not"], scenario=["always"], positive=["love"])
    value = "video is slow slow, always not good"
    n = len(value)
    want = 2 + min(2 / (n / 50) * 2, 4) + 1 + 1.5 + 1
    assert one(spark, tagging.relevance_score("t", rule, words), t=value) == pytest.approx(want)
    assert one(spark, tagging.relevance_score("t", rule, words), t="slow slow slow") == 0.0


def test_tag_best_prefers_hits_then_order(spark):
    rules = [Rule("a", "A", keywords=("x",)), Rule("b", "B", keywords=("y", "z")), Rule("c", "C", keywords=("y", "z"))]
    got = column_values(spark, ["x y", "y z", "none"], tagging.tag_best("c", rules))
    assert [(r.label, r.hits) if r else None for r in got] == [("A", 1), ("B", 2), None]


def test_match_rules_excludes_and_counts(spark):
    rules = [Rule("a", patterns=(r"slow\w*",), exclude=("fast",), relevance=("app", "video")), Rule("b", keywords=("fast",))]
    df = spark.createDataFrame([(1, "slowly app"), (2, "slow fast video"), (3, "nothing")], "id int, t string")
    got = sorted((r.id, r.rule_id, r.relevance) for r in tagging.match_rules(df, "t", rules).collect())
    assert got == [(1, "a", 1), (2, "b", 0)]


def test_rules_from_table(spark):
    from voxlode.lexicon import rules_from_table

    t = spark.createDataFrame(
        [("r2", 2, "Two", "c", "keyword", "k"), ("r1", 1, "One", "c", "pattern", "p"), ("r1", 1, "One", "c", "exclude", "e")],
        "rule_id string, ord int, label string, category string, kind string, term string")
    r1, r2 = rules_from_table(t)
    assert (r1.rule_id, r1.patterns, r1.exclude, r2.keywords) == ("r1", ["p"], ["e"], ["k"])
