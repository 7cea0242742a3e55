"""Predicates and quality rules over feedback texts.  All rule lists come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import parse_ts
from .text import col, count_occurrences, count_present, extract_terms, has_any, let, trim_all


@dataclass(frozen=True)
class QualityRules:
    """Word lists and patterns of one language.

    ``reject``: ordered (id, regex); ``incoherent``: regexes, two of which make a text incoherent;
    ``indicators``: words of useful feedback.
    """

    reject: Sequence[tuple[str, str]] = ()
    incoherent: Sequence[str] = ()
    indicators: Sequence[str] = ()
    sentence_end: str = "[.!?。！？]"
    question: str = "[?？]"
    term: str = r"\p{L}{3,}"


def match_any_pattern(c: Column | str, patterns: Sequence[tuple[str, str]]) -> Column:
    """Id of the first pattern found in the text, null if none."""
    s = col(c)
    hits = [F.when(s.rlike(p), F.lit(name)) for name, p in patterns]
    return F.coalesce(*hits) if hits else F.lit(None).cast("string")


def is_incoherent(c: Column | str, rules: QualityRules) -> Column:
    """Too many questions, two suspicious patterns, or neighbouring sentences without shared terms."""
    s = col(c)
    sentences = F.filter(
        F.transform(F.split(s, rules.sentence_end), trim_all), lambda x: F.length(x) > 3
    )
    questions = F.length(s) - F.length(F.regexp_replace(s, rules.question, ""))
    odd = F.lit(0)
    for p in rules.incoherent:
        odd = odd + s.rlike(p).cast("int")

    def jumps(sent: Column) -> Column:
        n = F.size(sent)
        terms = F.transform(sent, lambda x: F.array_distinct(extract_terms(x, rules.term)))

        def shared(t: Column) -> Column:
            pairs = F.zip_with(
                F.slice(t, F.lit(1), n - 1), F.slice(t, F.lit(2), n - 1), lambda a, b: F.size(F.array_intersect(a, b))
            )
            return F.aggregate(pairs, F.lit(0), lambda acc, x: acc + x) * 2 < n - 1

        asks = (n > 0) & (questions * 2 > n)
        return asks | F.when(n >= 4, let(terms, shared)).otherwise(F.lit(False))

    return (odd >= 2) | let(sentences, jumps)


def assess_quality(df: DataFrame, text: str, rules: QualityRules, min_score: float = 2.0) -> DataFrame:
    """Add ``quality_score``, ``quality_reason`` and ``keep`` for the text column.

    Starts at 5; length shifts it by -2, +1 or +2, useful words by up to +2; too short,
    rejected or incoherent texts get 0.
    """
    s = F.coalesce(F.col(text), F.lit(""))
    n = F.length(s)
    staged = df.withColumns(
        {
            "_reject": match_any_pattern(s, rules.reject),
            "_useful": count_present(s, rules.indicators),
            # The costly test runs only on texts the cheap ones let through.
            "_jumpy": F.when(
                (n >= 20) & match_any_pattern(s, rules.reject).isNull(), is_incoherent(s, rules)
            ).otherwise(F.lit(False)),
        }
    )
    length_part = F.when(n < 30, -2.0).when(n >= 100, 2.0).when(n >= 50, 1.0).otherwise(0.0)
    useful_part = F.least(F.col("_useful") * 0.5, F.lit(2.0))
    out = staged.withColumns(
        {
            "quality_score": F.when((n < 20) | F.col("_reject").isNotNull() | F.col("_jumpy"), 0.0).otherwise(
                F.round(5.0 + length_part + useful_part, 2)
            ),
            "quality_reason": F.when(n < 20, "too_short")
            .when(F.col("_reject").isNotNull(), F.concat(F.lit("low_quality_pattern:"), F.col("_reject")))
            .when(F.col("_jumpy"), "incoherent")
            .otherwise(F.concat(F.lit("hq="), F.col("_useful").cast("string"))),
        }
    )
    return out.withColumn("keep", F.col("quality_score") >= min_score).drop("_reject", "_useful", "_jumpy")


@dataclass(frozen=True)
class SampleRules:
    """Extra lists for judging a text as evidence of one demand."""

    structure: Sequence[tuple[Sequence[str], Sequence[str]]] = ()
    negative: Sequence[str] = ()
    scenario: Sequence[str] = ()


def sample_quality(
    c: Column | str,
    gate: Column,
    title_terms: Sequence[str],
    keywords: Sequence[str],
    rules: QualityRules,
    sample: SampleRules,
) -> Column:
    """Quality of a text as evidence for a demand, 0..10.

    ``gate`` is true where the general tests (rejected, incoherent) passed; compute it once per
    text.  ``structure`` lists (all of, any of) word groups.
    """
    low = F.lower(col(c))
    return sample_quality_of(c, gate, count_present(low, title_terms) + count_present(low, keywords), rules, sample)


def sample_quality_of(c: Column | str, gate: Column, related: Column, rules: QualityRules, sample: SampleRules) -> Column:
    """:func:`sample_quality` where the number of ``related`` words present is known."""
    s = col(c)
    n = F.length(s)
    built = F.lit(False)
    for every, some in sample.structure:
        part = F.lit(True)
        for w in every:
            part = part & s.contains(w)
        built = built | (part & has_any(s, some))
    score = (
        F.lit(5.0)
        + F.when(n < 30, -2.0).when(n >= 50, 1.0).otherwise(0.0)
        + F.least(count_present(s, rules.indicators) * 0.5, F.lit(2.0))
        + F.least(related * 0.5, F.lit(2.0))
        + F.when(built, 1.0).otherwise(0.0)
        - F.when(count_present(s, sample.negative) >= 3, 2.0).otherwise(0.0)
        + F.when(has_any(s, sample.scenario), 0.5).otherwise(0.0)
    )
    return F.when((n < 20) | ~gate, 0.0).otherwise(F.least(F.greatest(score, F.lit(0.0)), F.lit(10.0)))


def passes_rules(c: Column | str, rules: QualityRules) -> Column:
    """The gate of :func:`sample_quality`: not rejected and not incoherent."""
    s = col(c)
    bad = match_any_pattern(s, rules.reject).isNotNull()
    return F.when(bad, F.lit(False)).otherwise(~is_incoherent(s, rules))


def is_low_quality_comment(c: Column | str, phrases: Sequence[str]) -> Column:
    """Short, mostly symbols, a stock phrase, a bare link, short shouting, or a stuck key."""
    t = trim_all(F.coalesce(col(c), F.lit("")))
    n = F.length(t)
    letters = F.length(F.regexp_replace(t, r"[^\p{L}\p{N}]", ""))
    bare = F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}_]", "")
    return (
        (n < 30)
        | (letters / F.greatest(n, F.lit(1)) < 0.4)
        | bare.isin(list(phrases))
        | t.rlike(r"^https?://\S+$")
        | ((n < 60) & t.rlike(r"\p{Lu}") & ~t.rlike(r"\p{Ll}"))
        | t.rlike(r"([^\n])\1{6,}")
    )


def is_civil(c: Column | str, offensive: Sequence[str], emotional: Sequence[str]) -> Column:
    """No offensive pattern, at most two emotional hits, none at all in short texts."""

    def judged(s: Column) -> Column:
        hits = F.lit(0)
        for p in emotional:
            hits = hits + F.regexp_count(s, F.lit(p))
        rude = s.rlike("|".join(f"(?:{p})" for p in offensive)) if offensive else F.lit(False)
        # Hits are counted in one branch only.
        return ~rude & F.when(F.length(s) < 30, hits == 0).otherwise(hits <= 2)

    return let(F.lower(col(c)), judged)


def has_information(c: Column | str) -> Column:
    """30 to 300 characters, at least 20 word characters and 10 different ones."""
    s = col(c)
    plain = F.regexp_replace(s, r"[^\x{4e00}-\x{9fa5}\p{IsLatin}0-9]", "")
    fits = F.length(s).between(30, 300)
    # Only texts of fitting length are split into characters.
    kinds = F.size(F.array_distinct(F.split(F.when(fits, s), "")))
    return F.coalesce(fits & (F.length(plain) >= 20) & (kinds >= 10), F.lit(False))


def is_strongly_relevant(c: Column | str, keywords: Sequence[str]) -> Column:
    """Two different keywords, or two hits, or one hit in a text of 60 characters and more."""
    s = F.lower(col(c))
    kinds, hits = F.lit(0), F.lit(0)
    for k in dict.fromkeys(w.lower() for w in keywords):
        n = count_occurrences(s, k)
        kinds, hits = kinds + (n > 0).cast("int"), hits + n
    return (kinds >= 2) | (hits >= 2) | ((F.length(col(c)) >= 60) & (kinds >= 1))


def on_topic_terms(c: Column | str, include: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    """Any include keyword and no exclude keyword, ignoring case."""
    s = F.lower(col(c))
    hit = has_any(s, [w.lower() for w in include])
    return hit & ~has_any(s, [w.lower() for w in exclude]) if exclude else hit


def is_tech_issue(c: Column | str, keywords: Sequence[str], need_patterns: Sequence[str]) -> Column:
    """A technical keyword and no sign of a need."""
    need = col(c).rlike("|".join(f"(?:{p})" for p in need_patterns)) if need_patterns else F.lit(False)
    return has_any(F.lower(col(c)), [k.lower() for k in keywords]) & ~need


def on_topic(
    category: Column | str,
    source: Column | str,
    text: Column,
    topics: Mapping[str, Sequence[str]],
    source_name: str,
    excluded: Sequence[str] = (),
) -> Column:
    """Rows of ``source_name`` must hit a keyword of their category; excluded categories drop that source.

    Categories without keywords, and other sources, pass.
    """
    low = F.lower(text)
    ok = F.lit(True)
    for name, words in topics.items():
        ok = F.when(col(category) == name, has_any(low, [w.lower() for w in words])).otherwise(ok)
    if excluded:
        ok = ok & ~col(category).isin(list(excluded))
    return (col(source) != source_name) | ok


def low_rating(c: Column | str, at_most: int = 3) -> Column:
    """True for ratings up to ``at_most`` and for rows of sources without ratings."""
    return col(c).isNull() | (col(c) <= at_most)


def pain_related(c: Column | str, keywords: Sequence[str]) -> Column:
    return has_any(F.lower(col(c)), [k.lower() for k in keywords])


def drop_stale_evidence(
    evidence: DataFrame,
    known_dates: DataFrame,
    cutoff: str,
    source_name: str,
    id_floor: int,
    url: str = "source_url",
) -> DataFrame:
    """Drop old evidence rows of one source.

    ``known_dates`` has unique ``url`` and ``created_at``.  A row is old when its known date or
    its own date is before the cutoff, or the numeric id in its link is below ``id_floor``.
    Other sources stay.
    """
    limit = parse_ts(F.lit(cutoff))
    seen = known_dates.select(F.col("url").alias(url), F.col("created_at").alias("_known"))
    # Only rows of the named source need the lookup; the rest never enters the join.
    mine = evidence.filter(F.col("source") == source_name).join(seen, url, "left")
    item = F.regexp_extract(F.col(url), r"item\?id=(\d+)", 1)
    old = (
        F.coalesce(parse_ts("_known") < limit, F.lit(False))
        | F.coalesce(parse_ts("date") < limit, F.lit(False))
        | F.coalesce(F.when(item != "", item.cast("bigint") < id_floor), F.lit(False))
    )
    others = evidence.filter((F.col("source") != source_name) | F.col("source").isNull())
    return others.unionByName(mine.filter(~old).drop("_known"))
