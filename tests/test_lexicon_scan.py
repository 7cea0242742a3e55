"""Word lookup and rules on it against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from voxlode.lexicon import Rule, rules_from_table
from voxlode.operators import lexicon_scan, tagging, terms

ALPHABET = "ab é\x00"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=40), max_size=6), st.lists(st.text(ALPHABET, min_size=1, max_size=20), max_size=12), st.integers(1, 64))
def test_words_are_counted(texts, words, lot):
    index = terms.WordIndex(words)
    old, terms.LOT = terms.LOT, lot
    try:
        got = list(zip(*(x.tolist() for x in index.counts([t.encode() for t in texts]))))
    finally:
        terms.LOT = old
    want = [(i, index.number[w.encode()], t.count(w)) for i, t in enumerate(texts) for w in sorted(set(words), key=str.encode) if w in t]
    assert got == sorted(want)


@pytest.mark.parametrize(
    ("pattern", "literal"),
    [("the \\p{L}*ing", "the "), ("for (the|a)", "for "), ("[Aa]n \\p{L}+tion", "tion"), ("a|b", None), ("ab?c+d", "a"), ("x{2}yz", "yz"), ("\\.\\.end", "..end"), ("(?i)abc", None), ("[^]x]yy", "yy"), ("\\d+ kg", " kg"), ("", None), ("ab+", "ab"), ("\\x{41}bc", "bc")],
)
def test_required_literal(pattern, literal):
    assert terms.required_literal(pattern) == literal


@settings(max_examples=200, deadline=None)
@given(st.from_regex(r"(a|b|c|\[ab\]|\(a\|b\)|\.|a\?|b\+|c\*|\\w|a\{1,2\}){1,6}", fullmatch=True), st.data())
def test_every_match_holds_the_literal(pattern, data):
    found = data.draw(st.from_regex(re.compile(pattern), fullmatch=True))
    assert (terms.required_literal(pattern) or "") in found


def test_short_classes_are_ascii():
    assert regex.search(lexicon_scan.ascii_classes(r"^\w+[\d\s]\S$"), "ab1x") and not regex.search(lexicon_scan.ascii_classes(r"^\w+$"), "é")


def test_large_lexicon(spark, monkeypatch):
    """20,000 rules of ten words in several parts, counted as by hand."""
    monkeypatch.setattr(lexicon_scan, "PART_BYTES", 600_000)
    r = random.Random(4)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.choice([3, 5, 8, 11]))) for _ in range(60_000)]
    rules = [Rule(f"r{i:05d}", keywords=r.sample(words, 6), exclude=r.sample(words, 2), relevance=r.sample(words, 2), patterns=(f"{r.choice(words)} [xy]",) if i % 50 == 0 else ()) for i in range(20_000)]
    texts = [" ".join(r.choice(words) + r.choice(["", " x", " y"]) for _ in range(20)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)
    got = Counter((x.id, x.rule_id, x.rule_ord, x.relevance) for x in tagging.match_rules(df, "t", rules).collect())
    want = Counter()
    for i, t in enumerate(texts):
        inside = {w for w in words if w in t}
        for k, rule in enumerate(rules):
            if (any(w in inside for w in rule.keywords) or any(re.search(p, t) for p in rule.patterns)) and not any(w in inside for w in rule.exclude):
                want[(i, rule.rule_id, k, sum(w in inside for w in set(rule.relevance)))] += 1
    assert want and got == want
    best = {x.id: (x.label, x.hits) for x in tagging.best_rules(df, "t", rules).collect()}
    for i, t in enumerate(texts):
        n = [sum(w in t for w in set(rule.keywords)) for rule in rules]
        assert best[i] == ((rules[int(np.argmax(n))].rule_id, max(n)) if max(n) else (None, None))


def test_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "slow app", "z")], "id int, t string, c0 string")
    rules = [Rule("a", keywords=("slow",), relevance=("app",))]
    assert [tuple(r) for r in tagging.match_rules(df, "t", rules).collect()] == [(3, "slow app", "z", "a", 0, 1)]
    assert sorted((r.id, r.label, r.hits) for r in tagging.best_rules(df, "t", rules).collect()) == [(1, None, None), (2, None, None), (3, "a", 1)]
    assert not tagging.match_rules(df.limit(0), "t", rules).collect()


def test_a_table_of_any_number_of_rules(spark, monkeypatch):
    t = spark.range(3000).selectExpr("concat('r', id) AS rule_id", "cast(id AS int) AS ord", "'' AS label", "'' AS category", "'keyword' AS kind", "concat('word', id) AS term")
    assert len(rules_from_table(t)) == 3000
    monkeypatch.setattr("voxlode.lexicon.MAX_BYTES", 100)
    with pytest.raises(ValueError):
        rules_from_table(t)


def test_many_demands(spark):
    """10,000 demands of a table, rated as one by one."""
    from pyspark.sql import functions as F

    from voxlode.functions.quality import QualityRules, SampleRules
    from voxlode.operators import evidence

    r = random.Random(8)
    words = ["".join(r.choice("abcdef") for _ in range(r.choice([4, 6, 9]))) for _ in range(8_000)]
    made = [(f"d{i:05d}", f"Better {r.choice(words)}", r.sample(words, 3)) for i in range(10_000)]
    demands = evidence.demands_from_table(spark.createDataFrame(made, "demand_id string, title string, keywords array<string>").repartition(3))
    assert demands == made
    texts = [" ".join(r.choice(words) for _ in range(12)) for _ in range(30)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    terms_of = lambda t: [w for w in t.split(" ") if w != "Better"]
    got = Counter((x.id, x.demand_id, x.relevance, x.quality) for x in evidence.rated_for_demands(df, "t", demands, terms_of, QualityRules(), SampleRules()).collect())
    want = Counter()
    for i, t in enumerate(texts):
        inside = {w for w in words if w in (t or "")}
        for d, title, kw in made:
            relevance = len(inside & {*terms_of(title), *kw})
            related = len(inside & set(terms_of(title))) + len(inside & set(kw))
            if relevance:
                want[(i, d, relevance, 6.0 + min(related * 0.5, 2.0))] += 1
    assert want and got == want
    assert evidence.rated_for_demands(df.filter(F.col("id") < 0), "t", demands, terms_of, QualityRules(), SampleRules()).count() == 0


def test_matches_are_handed_on_in_pieces():
    """A text that meets many rules isn't repeated for all of them at once."""
    texts = lexicon_scan.pa.array(["x" * (1 << 16), None, "y"])
    at, rule = np.repeat(np.arange(3), 200), np.tile(np.arange(200), 3)
    got = list(lexicon_scan.pieces([texts], at, [lexicon_scan.pa.array(rule)]))
    assert max(p[0].nbytes for p in got) < 2 * lexicon_scan.LOT_BYTES
    assert [v for p in got for v in zip(p[0].to_pylist(), p[1].to_pylist())] == list(zip(texts.take(lexicon_scan.pa.array(at)).to_pylist(), rule.tolist()))


def test_text_is_not_carried(spark):
    rules = [Rule(f"r{i}", keywords=["ab"], relevance=["b"]) for i in range(5)]
    rows = spark.createDataFrame([(i, "ab" * i) for i in range(4)] + [(9, None)], "id long, text string")
    lean = tagging.match_rules(rows, "text", rules, carry=["id"])
    assert lean.columns == ["id", "rule_id", "rule_ord", "relevance"]
    whole = tagging.match_rules(rows, "text", rules)
    assert sorted(map(tuple, lean.collect())) == sorted(map(tuple, whole.drop("text").collect())) and lean.count() == 15
