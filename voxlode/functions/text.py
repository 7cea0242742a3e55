"""Scalar text functions: ``Column -> Column``, evaluated in the JVM unless a docstring says otherwise."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..patterns import ascii_classes

SPACE = r"[\s\x{85}\p{Z}]"

# The entities decoded first, in this order (later ones see the output of earlier ones).
ENTITIES = {
    "&#x27;": "'",
    "&quot;": '"',
    "&gt;": ">",
    "&lt;": "<",
    "&#x2F;": "/",
    "&amp;": "&",
    "&#x3D;": "=",
    "&nbsp;": " ",
    "&#32;": " ",
    "&#39;": "'",
    "&#34;": '"',
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def trim_all(c: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(col(c), f"^{SPACE}+|{SPACE}+$", "")


def squeeze(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(c), f"{SPACE}+", " "))


def any_of(words: Sequence[str]) -> str:
    """One alternation matching any of the literal ``words``."""
    return "|".join(re.escape(w).replace(r"\ ", " ") for w in words)


def has_any(c: Column, words: Sequence[str]) -> Column:
    """True when ``c`` contains any of the words as a substring."""
    return c.rlike(any_of(words)) if words else F.lit(False)


def count_present(c: Column, words: Sequence[str]) -> Column:
    """How many of the distinct ``words`` occur in ``c``."""
    total = F.lit(0)
    for w in dict.fromkeys(words):
        total = total + c.contains(w).cast("int")
    return total


def count_occurrences(c: Column, word: str) -> Column:
    """Non-overlapping occurrences of ``word``."""
    gone = F.length(F.replace(c, F.lit(word), F.lit("")))
    return ((F.length(c) - gone) / F.lit(len(word))).cast("int")


# ---------------------------------------------------------------- clean-up


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def clean_html(c: Column | str, drop_code: bool = False) -> Column:
    """Markup to plain text: entities, tags to blanks, runs of white space to one blank.

    The common entities are decoded in the JVM.  Only texts that still hold something that
    looks like an entity reach Python, in Arrow batches; the others travel as null.
    ``drop_code`` also removes the text inside script and style elements.
    """
    s = F.coalesce(col(c), F.lit(""))
    if drop_code:
        s = F.regexp_replace(s, r"(?is)<(script|style)\b.*?</(script|style)>", " ")
    for name, char in ENTITIES.items():
        s = F.replace(s, F.lit(name), F.lit(char))
    rest = _unescape(F.when(s.rlike("&#?[A-Za-z0-9]"), s))
    s = F.coalesce(rest, s)
    return squeeze(F.regexp_replace(s, "<[^>]+>", " "))


def strip_symbols(c: Column | str) -> Column:
    """Line breaks to blanks; code points beyond the basic plane removed."""
    s = F.translate(F.coalesce(col(c), F.lit("")), "\n\r", "  ")
    return trim_all(F.regexp_replace(s, r"[\x{10000}-\x{10FFFF}]", ""))


def truncate(c: Column | str, n: int, ellipsis: str = "...", one_line: bool = True) -> Column:
    s = F.replace(col(c), F.lit("\n"), F.lit(" ")) if one_line else col(c)
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit(ellipsis))).otherwise(s)


def content_key(c: Column | str, n: int = 50) -> Column:
    """Lookup key of a text: trimmed, one line, first ``n`` characters."""
    return F.substring(F.translate(trim_all(c), "\n", " "), 1, n)


def script_ratio(c: Column | str, char_class: str) -> Column:
    """Share of characters inside ``char_class`` (the inside of a regex bracket)."""
    s = F.coalesce(col(c), F.lit(""))
    return F.length(F.regexp_replace(s, f"[^{char_class}]", "")) / F.greatest(F.length(s), F.lit(1))


def has_script(c: Column | str, char_class: str) -> Column:
    return F.coalesce(col(c).rlike(f"[{char_class}]"), F.lit(False))


# ---------------------------------------------------------------- terms


def extract_terms(
    c: Column | str,
    token: str,
    stopwords: Sequence[str] = (),
    distinct: bool = False,
    cap: int | None = None,
) -> Column:
    """Tokens in text order, without stopwords."""
    out = F.regexp_extract_all(col(c), F.lit(token), F.lit(0))
    if stopwords:
        stop = F.array(*[F.lit(w) for w in stopwords])
        out = F.filter(out, lambda t: ~F.array_contains(stop, t))
    if distinct:
        out = F.array_distinct(out)
    return F.slice(out, 1, cap) if cap else out


def top_terms(c: Column | str, token: str, n: int, stopwords: Sequence[str] = ()) -> Column:
    """The ``n`` most frequent terms of one text, ties by first appearance; none for a null text.

    Texts come in Arrow batches; each is split and counted by compiled code, in time linear in its length and without a shuffle.
    """
    pattern, stop = ascii_classes(token), frozenset(stopwords)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(texts: pd.Series) -> pd.Series:
        find = regex.compile(pattern).finditer

        def one(s: str | None) -> list[str]:
            # Equal counts keep the order in which their terms came.
            count = Counter(m[0] for m in find(s)) if s else Counter()
            for w in stop & count.keys():
                del count[w]
            return [t for t, _ in count.most_common(n)]

        return texts.map(one)

    return run(col(c))


def term_overlap(a: Column, b: Column) -> Column:
    """Share of the distinct terms of ``a`` that ``b`` has too (0 for an empty ``a``)."""
    mine = F.array_distinct(a)
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(mine), F.lit(1))


def extract_intent(
    c: Column | str, patterns: Sequence[tuple[str, int]], fallback_chars: int | None = None
) -> Column:
    """Capture of the first pattern (in priority order) that matches, trimmed; else null or the text start."""
    s = col(c)
    tries = [F.when(s.rlike(p), trim_all(F.regexp_extract(s, p, g))) for p, g in patterns]
    if fallback_chars:
        tries.append(truncate(s, fallback_chars, one_line=False))
    return F.coalesce(*tries)


# ---------------------------------------------------------------- statements


@dataclass(frozen=True)
class StatementForm:
    """How statements of one language start, and the uniform prefix they get.

    ``opener``: subject and wish verb; ``modal``: a bare modal; ``subject`` and ``subject_modal``:
    the two halves of "subject modal ...".  All are regex text without anchors.
    """

    prefix: str
    opener: str
    modal: str
    subject: str
    subject_modal: str
    generic_subjects: Sequence[str] = ()
    colon: str = ":"
    lead_punctuation: str = ",.:; "


def normalize_statement(c: Column | str, form: StatementForm) -> Column:
    """Rewrite the start of a statement into ``form.prefix``; unmatched ones get the prefix and a colon."""
    raw = F.coalesce(col(c), F.lit(""))
    s = trim_all(raw)
    third = f"^({form.subject})" + r"\s*" + f"(?:{form.subject_modal})" + r"\s*"
    opener = f"^(?:{form.opener})" + r"\s*"
    modal = f"^(?:{form.modal})" + r"\s*"
    subject = F.trim(F.regexp_extract(s, third, 1))
    kept = F.when(subject.isin(list(form.generic_subjects)), F.lit("")).otherwise(F.concat(subject, F.lit(" ")))
    body = (
        F.when(s.rlike(opener), F.regexp_replace(s, opener, ""))
        .when(s.rlike(modal), F.regexp_replace(s, modal, ""))
        .when(s.rlike(third), F.concat(kept, F.regexp_replace(s, third, "")))
        .otherwise(s)
    )
    tidy = F.regexp_replace(squeeze(body), "^[" + re.escape(form.lead_punctuation).replace(r"\ ", " ") + "]+", "")
    hit = s.rlike(f"{opener}|{modal}|{third}")
    shown = F.when(hit, F.concat(F.lit(form.prefix + " "), tidy)).otherwise(
        F.concat(F.lit(form.prefix + form.colon), F.when(tidy == "", raw).otherwise(tidy))
    )
    return F.when(raw == "", F.lit("")).otherwise(shown)


def compose_text(parts: Sequence[tuple[Column | str, int | None]], sep: str = " | ") -> Column:
    """Join several columns into the text to embed; each part may have a length cap."""
    cut = [F.coalesce(col(c), F.lit("")) for c, _ in parts]
    return F.concat_ws(sep, *[F.substring(c, 1, n) if n else c for c, (_, n) in zip(cut, parts)])


# ---------------------------------------------------------------- sources and ids


def split_source(c: Column | str, placeholder: str = "[dead]", sep: str = " - ") -> Column:
    """``"Platform - Rest"`` as struct(platform, label); the label is null when missing or a placeholder."""
    bits = F.split(col(c), re.escape(sep).replace(r"\ ", " ").replace(r"\-", "-"), 2)
    rest = F.get(bits, 1)
    label = F.when((rest == "") | (rest == placeholder), F.lit(None)).otherwise(rest)
    return F.struct(F.get(bits, 0).alias("platform"), label.alias("label"))


def channel_of_url(c: Column | str, fragments: Sequence[tuple[str, str]], default: str) -> Column:
    """Channel of the first URL fragment found."""
    url = F.coalesce(col(c), F.lit(""))
    pairs = [F.when(url.contains(frag), F.lit(name)) for frag, name in fragments]
    return F.coalesce(*pairs, F.lit(default))


def source_url(
    url: Column | str, source: Column | str, templates: Sequence[tuple[str, Column, str]]
) -> Column:
    """Given URL, else built from the first template whose source name occurs.

    ``templates``: (source fragment, id column, template with one ``{}``).
    """
    given = F.when(F.coalesce(col(url), F.lit("")) != "", col(url))
    built = F.lit("")
    for frag, key, form in reversed(templates):
        head, tail = form.split("{}")
        k = key.cast("string")
        made = F.when(F.coalesce(k, F.lit("")) == "", F.lit("")).otherwise(F.concat(F.lit(head), k, F.lit(tail)))
        built = F.when(col(source).contains(frag), made).otherwise(built)
    return F.coalesce(given, built)


def stable_id(prefix: str, key: Column | str, content: Column | str, n: int = 8) -> Column:
    """Prefixed id; rows without a key get the start of the content's md5."""
    k = col(key).cast("string")
    return F.concat(
        F.lit(prefix),
        F.coalesce(F.when(k != "", k), F.substring(F.md5(F.coalesce(col(content), F.lit(""))), 1, n)),
    )


def map_value(c: Column | str, values: Mapping[str, float], default: float) -> Column:
    """Category to number with a default for unknown or missing values."""
    out = F.lit(float(default))
    for k, v in values.items():
        out = F.when(col(c) == k, F.lit(float(v))).otherwise(out)
    return out


def rating_bucket(c: Column | str) -> Column:
    """Rating to sentiment: up to 2, up to 4, above."""
    return F.when(col(c) <= 2, 0.2).when(col(c) <= 4, 0.6).otherwise(0.8)
