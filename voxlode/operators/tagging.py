"""Tagging and classification with lexicons.

All functions work on one text column.  Those returning a Column yield one value per text;
those returning a DataFrame yield one row per (text, matching rule).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import any_of, col, count_occurrences, count_present, has_any
from ..lexicon import Rule
from .lexicon_scan import Found, lookup, parts_of, scan


def _alternation(patterns: Sequence[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def tag_first(c: Column | str, rules: Sequence[Rule], category: Column | str | None = None) -> Column:
    """Label of the first rule with a keyword in the lower-cased text.

    With ``category``, only rules of the row's category apply.
    """
    low = F.lower(col(c))
    tests = []
    for r in rules:
        hit = has_any(low, [k.lower() for k in r.keywords])
        if category is not None:
            hit = hit & (col(category) == r.category)
        tests.append(F.when(hit, F.lit(r.label or r.rule_id)))
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def tag_all(c: Column | str, rules: Sequence[Rule]) -> Column:
    """Array of the labels of all rules with a matching pattern, in rule order."""
    s = col(c)
    tags = [F.when(s.rlike(_alternation(r.patterns)), F.lit(r.label or r.rule_id)) for r in rules]
    return F.filter(F.array(*tags), lambda t: t.isNotNull())


def match_rules(df: DataFrame, text: str, rules: Sequence[Rule], carry: Sequence[str] | None = None) -> DataFrame:
    """One row per (text, rule) with a pattern or keyword hit and no excluded word.

    Adds ``rule_id``, ``rule_ord`` and ``relevance``, the number of relevance words present, to the columns ``carry`` (by default all): a
    text that isn't among them isn't repeated for each of its rules.
    """
    ids = np.array([r.rule_id for r in rules], object)

    def judge(found: Found, rows: pa.RecordBatch, first: int) -> tuple[np.ndarray, list[pa.Array]]:
        hit = np.union1d(found.codes("keywords")[0], found.matched())
        hit = np.setdiff1d(hit, found.codes("exclude")[0], assume_unique=True)
        code, n, _ = found.codes("relevance")
        rule = hit % found.lexicon.n + first
        return hit // found.lexicon.n, [pa.array(ids[rule], pa.string()), pa.array(rule, pa.int32()), pa.array(lookup(code, n, hit), pa.int32())]

    return scan(df, F.col(text), rules, "rule_id string, rule_ord int, relevance int", judge, carry=carry)


def tag_best(c: Column | str, rules: Sequence[Rule]) -> Column:
    """Struct(label, hits) of the rule with most keywords present; ties go to the earlier rule."""
    low = F.lower(col(c))
    scored = F.array(*[
        F.struct(
            (-count_present(low, [k.lower() for k in r.keywords])).alias("neg"),
            F.lit(i).alias("ord"),
            F.lit(r.label or r.rule_id).alias("label"),
        )
        for i, r in enumerate(rules)
    ])
    best = F.array_min(F.filter(scored, lambda x: x["neg"] < 0))
    return F.when(best.isNotNull(), F.struct(best["label"].alias("label"), (-best["neg"]).alias("hits")))


def best_rules(df: DataFrame, text: str, rules: Sequence[Rule]) -> DataFrame:
    """Rows of ``df`` with ``label`` and ``hits`` of the rule with most keywords present, as :func:`tag_best` but for lexicons of any size.

    Texts without any keyword have nulls.
    """
    from ..session import cut

    labels = np.array([r.label or r.rule_id for r in rules], object)

    def judge(found: Found, rows: pa.RecordBatch, first: int) -> tuple[np.ndarray, list[pa.Array]]:
        code, n, _ = found.codes("keywords")
        t, rule = code // found.lexicon.n, code % found.lexicon.n
        order = np.lexsort((rule, -n, t))
        order = order[np.concatenate(([True], t[order][1:] != t[order][:-1]))] if len(order) else order
        rest = np.setdiff1d(np.arange(len(found.texts)), t)
        at = np.concatenate((t[order], rest))
        name = np.concatenate((labels[rule[order] + first], np.full(len(rest), None, object)))
        hits = pa.array([*n[order].tolist(), *[None] * len(rest)], pa.int32())
        return at, [pa.array(name, pa.string()), hits, pa.array([*(rule[order] + first).tolist(), *[None] * len(rest)], pa.int32())]

    plain = df.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    out = scan(plain, F.lower(F.col(text)), rules, "label string, hits int, best_ord int", judge, lower=True)
    if len(list(parts_of(rules))) > 1:  # each part has a best rule for each row
        key = F.struct(F.coalesce(-F.col("hits"), F.lit(0)).alias("n"), F.coalesce("best_ord", F.lit(0)).alias("o"))
        names = df.columns
        out = cut(out.groupBy(*names).agg(F.min_by(F.struct("label", "hits", "best_ord"), key).alias("_b"))).select(*names, "_b.*")
    return out.drop("best_ord")


def score_rules(df: DataFrame, text: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per (text, rule) with a positive score: one per keyword, two per pattern."""
    labels = np.array([r.label or r.rule_id for r in rules], object)

    def judge(found: Found, rows: pa.RecordBatch, first: int) -> tuple[np.ndarray, list[pa.Array]]:
        words, n, _ = found.codes("keywords")
        shapes, m = np.unique(found.matched(), return_counts=True)
        code = np.union1d(words, shapes)
        score = lookup(words, n, code) + 2 * lookup(shapes, m, code)
        return code // found.lexicon.n, [pa.array(labels[code % found.lexicon.n + first], pa.string()), pa.array(score, pa.int32())]

    return scan(df, F.lower(F.col(text)), rules, "label string, score int", judge, lower=True)


def lexicon_sentiment(c: Column | str, positive: Sequence[str], negative: Sequence[str]) -> Column:
    low = F.lower(col(c))
    diff = count_present(low, positive) - count_present(low, negative)
    return F.when(diff > 0, "positive").when(diff < 0, "negative").otherwise("neutral")


@dataclass(frozen=True)
class RelevanceWords:
    negative: Sequence[str] = ()
    scenario: Sequence[str] = ()
    positive: Sequence[str] = ()


def relevance_score(c: Column | str, rule: Rule, words: RelevanceWords, lowered: Column | None = None) -> Column:
    """How strongly a text speaks of a rule's problem.

    Two points per keyword present, up to four for their density (per 50 characters), one for a
    negative marker, 1.5 for a scenario word, one for 20 to 200 characters, minus two below ten,
    minus two for a positive context; never below zero, and zero without a required context word.
    """
    s = col(c)
    low = F.lower(s) if lowered is None else lowered
    n = F.length(s)
    keys = list(dict.fromkeys(k.lower() for k in rule.keywords))
    occurrences = F.lit(0)
    for k in keys:
        occurrences = occurrences + count_occurrences(low, k)
    density = F.when(n > 10, F.least(occurrences / (n / 50.0) * 2, F.lit(4.0))).otherwise(0.0)
    score = (
        count_present(low, keys) * 2.0
        + density
        + F.when(has_any(low, words.negative), 1.0).otherwise(0.0)
        + F.when(has_any(low, words.scenario), 1.5).otherwise(0.0)
        + F.when(n.between(20, 200), 1.0).when(n < 10, -2.0).otherwise(0.0)
        - F.when(has_any(low, words.positive), 2.0).otherwise(0.0)
    )
    score = F.greatest(score, F.lit(0.0))
    if rule.context:
        score = F.when(has_any(low, [w.lower() for w in rule.context]), score).otherwise(0.0)
    return score


def relevant_rules(
    df: DataFrame, text: str, rules: Sequence[Rule], words: RelevanceWords, threshold: float = 3.0
) -> DataFrame:
    """One row per (text, rule) with a keyword hit and a relevance of at least ``threshold``, by :func:`relevance_score`."""
    ids = np.array([r.rule_id for r in rules], object)
    needs_context = np.array([bool(r.context) for r in rules], bool)

    def judge(found: Found, rows: pa.RecordBatch, first: int) -> tuple[np.ndarray, list[pa.Array]]:
        code, present, times = found.codes("keywords")
        at, rule = code // found.lexicon.n, code % found.lexicon.n + first
        n = np.asarray(rows.column(rows.num_columns - 1))[at]
        score = present * 2.0 + np.where(n > 10, np.minimum(times / (n / 50.0) * 2, 4.0), 0.0)
        score = score + found.flagged("negative")[at] * 1.0 + found.flagged("scenario")[at] * 1.5 + np.where((n >= 20) & (n <= 200), 1.0, 0.0) - found.flagged("positive")[at] * 2.0
        context = found.codes("context")[0]
        score = np.where(needs_context[rule] & ~np.isin(code, context), 0.0, np.maximum(score, 0.0))
        ok = score >= threshold
        return at[ok], [pa.array(ids[rule[ok]], pa.string()), pa.array(score[ok])]

    long_enough = df.filter(F.length(text) >= 10)
    shared = {"negative": words.negative, "scenario": words.scenario, "positive": words.positive}
    return scan(long_enough, F.lower(F.col(text)), rules, "rule_id string, relevance_score double", judge, lower=True, shared=shared, measures=[F.length(text)])


def keyword_hits(df: DataFrame, text: str, rating: str, rules: Sequence[Rule], max_rating: int = 3) -> DataFrame:
    """Low-rated texts per rule with the number of its keywords present."""
    ids = np.array([r.rule_id for r in rules], object)

    def judge(found: Found, rows: pa.RecordBatch, first: int) -> tuple[np.ndarray, list[pa.Array]]:
        code, n, _ = found.codes("keywords")
        return code // found.lexicon.n, [pa.array(ids[code % found.lexicon.n + first], pa.string()), pa.array(n, pa.int32())]

    return scan(df.filter(F.coalesce(F.col(rating), F.lit(5)) <= max_rating), F.col(text), rules, "rule_id string, hits int", judge)


def demand_tier(
    title: Column | str, experience: Sequence[str], feature: Sequence[str], problem: Sequence[str]
) -> Column:
    """3 for wishes about experience, 1 for features and concrete problems, else 2."""
    t = col(title)
    return (
        F.when(has_any(t, experience), 3).when(has_any(t, feature) | has_any(t, problem), 1).otherwise(2)
    )


def intervention_type(
    policy: str,
    key: Column | str,
    heavy: str,
    light: str,
    by_prefix: Mapping[str, str] | None = None,
) -> Column:
    """Heavy or light intervention, from a rule-id prefix, a score (>= 7) or a priority (P0, P1)."""
    k = col(key)
    if policy == "score":
        return F.when(k >= 7, heavy).otherwise(light)
    if policy == "priority":
        return F.when(k.isin("P2", "P3"), light).otherwise(heavy)
    if policy == "prefix":
        head = F.substring_index(k, "_", 1)
        out = F.lit(light)
        for name, value in (by_prefix or {}).items():
            out = F.when(head == name, F.lit(value)).otherwise(out)
        return out
    raise ValueError(f"unknown policy {policy}")


@dataclass(frozen=True)
class Scene:
    """A scene recognised by any of ``any_of`` (and any of ``also``), with an optional stronger reading."""

    words: Sequence[str]
    sentence: str
    also: Sequence[str] = ()
    when_words: Sequence[str] = ()
    when_sentence: str = ""


def summarize_by_scene(
    demands: DataFrame,
    samples: DataFrame,
    key: str,
    title: str,
    text: str,
    order: Sequence[Column],
    scenes: Sequence[Scene],
    wish_words: Sequence[str] = (),
    templates: tuple[str, str, str] = (
        "Users want {core} because {scene}",
        "Users hope for {core}",
        "Users hope for {title}, which works badly today",
    ),
    n: int = 5,
) -> DataFrame:
    """Demand rows plus ``user_voice``: a sentence from the first scene found in the top samples."""
    w = W.partitionBy(key).orderBy(*order)
    top = samples.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    # At most n texts per demand are packed together.
    packed = top.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_r", F.col(text).alias("t")))).alias("_s"))
    packed = packed.select(key, F.array_join(F.transform("_s", lambda x: x["t"]), " ").alias("_all"))
    a = F.col("_all")
    scene = F.lit(None).cast("string")
    for sc in reversed(scenes):
        hit = has_any(a, sc.words)
        if sc.also:
            hit = hit & has_any(a, sc.also)
        said = F.lit(sc.sentence)
        if sc.when_words:
            said = F.when(has_any(a, sc.when_words), sc.when_sentence).otherwise(said)
        scene = F.when(hit, said).otherwise(scene)
    core = F.col(title)
    for wword in wish_words:
        core = F.replace(core, F.lit(wword), F.lit(""))
    core = F.trim(core)

    def fill(template: str) -> Column:
        out = F.lit(template)
        for name, value in (("{core}", core), ("{scene}", F.coalesce("_scene", F.lit(""))), ("{title}", F.col(title))):
            out = F.replace(out, F.lit(name), value)
        return out

    joined = demands.join(packed, key, "left").withColumn("_scene", scene)
    voice = (
        F.when(F.col("_all").isNull(), fill(templates[2]))
        .when(F.col("_scene").isNotNull(), fill(templates[0]))
        .otherwise(fill(templates[1]))
    )
    return joined.withColumn("user_voice", voice).drop("_all", "_scene")


def explain_keywords(
    keywords: Column | str,
    score: Column | str,
    explanations: Mapping[str, str],
    fallbacks: Sequence[tuple[Sequence[str], str]],
    no_room: str,
    tentative: str,
    joiner: str = "; ",
) -> Column:
    """Explain the first three keywords and keep two explanations.

    Unknown keywords use the first fallback whose marker occurs (template with ``{kw}``).
    Without keywords or with a score up to 2 the answer is ``no_room``; without any
    explanation it is ``tentative`` with the first two keywords for ``{kws}``.
    """
    k = F.slice(F.coalesce(col(keywords), F.array().cast("array<string>")), 1, 3)
    table = F.create_map(*[F.lit(x) for pair in explanations.items() for x in pair])

    def one(x: Column) -> Column:
        out = F.lit(None).cast("string")
        for markers, template in reversed(list(fallbacks)):
            out = F.when(has_any(x, markers), F.replace(F.lit(template), F.lit("{kw}"), x)).otherwise(out)
        return F.coalesce(F.try_element_at(table, x), out)

    said = F.slice(F.filter(F.transform(k, one), lambda x: x.isNotNull()), 1, 2)
    none = (F.size(k) == 0) | (F.coalesce(col(score), F.lit(0)) <= 2)
    loose = F.replace(F.lit(tentative), F.lit("{kws}"), F.array_join(F.slice(k, 1, 2), ", "))
    return F.when(none, no_room).when(F.size(said) > 0, F.array_join(said, joiner)).otherwise(loose)


def phrases_of(c: Column | str, patterns: Sequence[tuple[str, int]]) -> Column:
    """All matches of the patterns with their capture groups joined by blanks; (pattern, groups)."""
    s = col(c)
    found = []
    for p, groups in patterns:
        parts = [F.regexp_extract_all(s, F.lit("(?i)" + p), F.lit(g + 1)) for g in range(groups)]
        joined = parts[0]
        for nxt in parts[1:]:
            joined = F.zip_with(joined, nxt, lambda a, b: F.concat_ws(" ", a, b))
        found.append(joined)
    return F.concat(*found)


def key_phrases(df: DataFrame, text: str, patterns: Sequence[tuple[str, int]], n: int = 20) -> DataFrame:
    """The ``n`` most frequent phrases, ties in alphabetical order."""
    rows = df.select(F.explode(phrases_of(text, patterns)).alias("phrase"))
    counts = rows.groupBy("phrase").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "phrase").limit(n)


__all__ = [
    "RelevanceWords", "Scene", "any_of", "best_rules", "demand_tier", "explain_keywords", "intervention_type", "key_phrases",
    "keyword_hits", "lexicon_sentiment", "match_rules", "phrases_of", "relevance_score", "relevant_rules",
    "score_rules", "summarize_by_scene", "tag_all", "tag_best", "tag_first",
]
