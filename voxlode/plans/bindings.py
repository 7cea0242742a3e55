"""Word lists and rules used by the registered queries on the given tables.

They are made of words and syllables that occur in those tables (English, German, French and
Spanish look-alikes), so that every branch of the rules is taken by some rows.
"""

from __future__ import annotations

import json

from ..functions.text import StatementForm

WORD = r"\p{L}{3,}"
STOPWORDS = ["the", "and", "that", "der", "die", "und", "les", "des", "que", "los", "del", "est"]

STATEMENT = StatementForm(
    prefix="Users suggest",
    opener=r"(?:The|Der|Que|Les)?\s*(?:and|with|und|von|pour|por|of)(?:,|:)?",
    modal=r"(?:Th|En|De)",
    subject=r"[\p{L}][\p{L}\s]{0,12}?",
    subject_modal=r"er|en|on|os",
    generic_subjects=["I", "Th", "An", "La", "E"],
)

INTENTS = [(r"with ([^\n]{5,50})", 1), (r"(?:mit|pour|para) ([^\n]{5,50})", 1), (r"(from|that) ([^\n]{5,30})", 2)]

URL_CHANNELS = [("example.org", "Forum"), ("//m.", "Mobile"), ("example.net", "Store")]


def sql_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The same trimming and squeezing as SQL text.
SP = r"[\s\x{85}\p{Z}]"


def sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{SP}+|{SP}+$', '', 'g')"


def sql_squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SP}+', ' ', 'g'))"


def sql_contains_any(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in words) + ")"


def sql_count_present(x: str, words) -> str:
    return "(" + " + ".join(f"CAST(contains({x}, {q(w)}) AS INTEGER)" for w in words) + ")"


def sql_occurrences(x: str, word: str) -> str:
    return f"CAST((length({x}) - length(replace({x}, {q(word)}, ''))) / {len(word)} AS INTEGER)"


def sql_truncate(x: str, n: int) -> str:
    s = f"replace({x}, chr(10), ' ')"
    return f"CASE WHEN length({s}) > {n} THEN substr({s}, 1, {n}) || '...' ELSE {s} END"


# ---------------------------------------------------------------- quality

from ..functions.quality import QualityRules, SampleRules  # noqa: E402

QUALITY = QualityRules(
    reject=[
        ("stub", r"^[^\n]{0,15}$"),
        ("table", r"\|[^\n]{0,20}\|"),
        ("licence", r"licensed under the GNU"),
        ("symbols", r"[%#$&*]{3}[^\n]{1,30}[%#$&*]{3}"),
        ("thin", r"^(That|Des|The)[^\n]{0,10}$"),
    ],
    incoherent=[r"\.\s*The", r"tion[^\n]{0,10}tion", r"ung[^\n]{0,10}ung"],
    indicators=["with", "from", "this", "nicht", "pour", "para", "dans", "mit", "was", "for"],
)

SAMPLE = SampleRules(
    structure=[(["the"], ["with", "from"]), ([], ["nicht"]), (["que"], ["pour", "para"])],
    negative=["and", "that", "ing", "und", "les"],
    scenario=["was ", "ist ", "est "],
)

PHRASES = ["ok", "thatit", "von"]
OFFENSIVE = [r"idiot", r"stupid"]
EMOTIONAL = [r"thanth", r"ungung", r"\.{5,}", r"ciónción"]
TECH_WORDS = ["tion", "keit", "ción"]
NEED_PATTERNS = [r"with (the|a)", r"von der", r"pour la", r"para (el|la)"]
TOPICS = {"chat": ["the ", "der "], "work": ["ing", "ung"], "media": ["que "]}
KEYWORDS = ["with", "from", "nicht", "dans", "para"]

# Demands: (id, title, keywords)
DEMANDS = [
    ("export", "Better with export from folder", ["with", "from"]),
    ("search", "Nicht mit suche", ["nicht", "mit", "und"]),
    ("share", "Share que pour para", ["que", "pour", "para"]),
]
TITLE_STOP = ["better", "share"]


def title_terms(title: str) -> list[str]:
    import re

    return [w for w in re.findall(r"[a-z]{2,}", title.lower()) if w not in TITLE_STOP]


def sql_reject(x: str, rules: QualityRules = QUALITY) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, {q(p)}) THEN {q(n)}" for n, p in rules.reject) + " END"


def sql_quality_cte(source: str, key: str, x: str, rules: QualityRules = QUALITY) -> str:
    """CTEs ending in ``quality(key, score, reason)``; needs columns ``key`` and ``x`` in ``source``."""
    odd = " + ".join(f"CAST(regexp_matches(x, {q(p)}) AS INTEGER)" for p in rules.incoherent)
    return f"""
base AS (SELECT {key} AS k, {x} AS x, {sql_reject(x, rules)} AS reject,
           {sql_count_present(x, rules.indicators)} AS useful FROM {source}),
sents AS (SELECT k, x, reject, useful,
  [s for s in [regexp_replace(z, '^{SP}+|{SP}+$', '', 'g') for z in string_split_regex(x, '{rules.sentence_end}')] if length(s) > 3] AS ss FROM base),
terms AS (SELECT *, [list_distinct(regexp_extract_all(s, '{rules.term}')) for s in ss] AS tt FROM sents),
coh AS (SELECT *, ({odd}) >= 2
   OR (len(ss) > 0 AND (length(x) - length(regexp_replace(x, '{rules.question}', '', 'g'))) * 2 > len(ss))
   OR (len(ss) >= 4 AND list_sum([len(list_intersect(tt[i], tt[i + 1])) for i in range(1, len(tt))]) * 2 < len(ss) - 1) AS jumpy
   FROM terms),
quality AS (SELECT k, x, jumpy, reject, useful,
  CASE WHEN length(x) < 20 OR reject IS NOT NULL OR jumpy THEN 0.0
    ELSE 5.0 + CASE WHEN length(x) < 30 THEN -2 WHEN length(x) >= 100 THEN 2 WHEN length(x) >= 50 THEN 1 ELSE 0 END
      + least(useful * 0.5, 2) END::DOUBLE AS score,
  CASE WHEN length(x) < 20 THEN 'too_short' WHEN reject IS NOT NULL THEN 'low_quality_pattern:' || reject
    WHEN jumpy THEN 'incoherent' ELSE 'hq=' || CAST(useful AS VARCHAR) END AS reason FROM coh)"""


# ---------------------------------------------------------------- lexicons

from ..lexicon import Rule  # noqa: E402
from ..operators.tagging import RelevanceWords, Scene  # noqa: E402

RULES = [
    Rule("speed_slow", "Slow answers", keywords=("thing", "ungen", "tionne"), patterns=(r"the \p{L}*ing", r"der \p{L}+ung"),
         exclude=("idiot",), relevance=("with", "from", "nicht", "mit"), category="en", kind="problem", score=7),
    Rule("search_find", "Find things", keywords=("that", "nicht", "dans", "para"), patterns=(r"for (the|a)", r"pour (la|les)"),
         exclude=("license",), relevance=("was", "this", "avec"), category="fr", kind="feature", score=9),
    Rule("price_high", "High price", keywords=("from", "auch", "ciónes"), patterns=(r"with \p{L}{8,}",),
         relevance=("and", "und"), category="de", kind="policy", score=4),
    Rule("login_fail", "Login fails", keywords=("erth", "heit", "mente"), patterns=(r"[ ]nd\p{L}+[ ]", r"[ ]que el[ ]"),
         exclude=("with the", "mit dem"), context=("this", "sich", "los"), relevance=("on", "en"), category="es", kind="problem", score=6),
    Rule("export_data", "Export data", keywords=("onto", "keit", "elle"), patterns=(r"[Aa]n \p{L}+tion",),
         relevance=("are", "ist", "est", "es"), category="en", kind="feature", score=8),
]
RELEVANCE = RelevanceWords(
    negative=["not", "nicht", "pas", "que no"], scenario=["was", "wird", "est "], positive=["thanth", "besser", "idiot"]
)
POSITIVE = ["and", "mit", "pour", "con", "this"]
NEGATIVE = ["the ", "nicht", "pas ", "del ", "that"]
PHRASE_PATTERNS = [(r"(with|from|for) (the|a|that)[ ]", 2), (r"(von|mit) (der|den|dem)[ ]", 2), (r"(pour) (la|les)[ ]", 2)]
SCENES = [
    Scene(("idiot",), "people are rude"),
    Scene(("licen",), "the licence is unclear", when_words=("MIT",), when_sentence="the short licence is unclear"),
    Scene(("was ", "est "), "it used to work", also=("with", "avec")),
    Scene(("nicht",), "it does not work"),
]
EXPLAIN = {"with": "combine the parts", "nicht": "find what is missing", "que": "ask back"}
EXPLAIN_FALLBACK = [(["fr"], "start from {kw}"), (["pa", "mi"], "improve {kw}")]


def sql_rule_rows(select, rules=RULES) -> str:
    """UNION ALL of ``select(rule, position)``."""
    return " UNION ALL ".join(select(r, i) for i, r in enumerate(rules))


def sql_hit(x: str, r: Rule) -> str:
    bits = []
    if r.keywords:
        bits.append(sql_contains_any(x, r.keywords))
    if r.patterns:
        bits.append(f"regexp_matches({x}, {q('|'.join(f'(?:{p})' for p in r.patterns))})")
    return "(" + " OR ".join(bits) + ")"


def sql_match(x: str, r: Rule) -> str:
    out = sql_hit(x, r)
    return f"({out} AND NOT {sql_contains_any(x, r.exclude)})" if r.exclude else out


def sql_relevance(x: str, r: Rule, w: RelevanceWords = RELEVANCE) -> str:
    low = f"lower({x})"
    occ = " + ".join(sql_occurrences(low, k) for k in r.keywords)
    score = f"""greatest({sql_count_present(low, r.keywords)} * 2.0
      + CASE WHEN length({x}) > 10 THEN least(({occ}) / (length({x}) / 50.0) * 2, 4) ELSE 0 END
      + CASE WHEN {sql_contains_any(low, w.negative)} THEN 1 ELSE 0 END
      + CASE WHEN {sql_contains_any(low, w.scenario)} THEN 1.5 ELSE 0 END
      + CASE WHEN length({x}) BETWEEN 20 AND 200 THEN 1 WHEN length({x}) < 10 THEN -2 ELSE 0 END
      - CASE WHEN {sql_contains_any(low, w.positive)} THEN 2 ELSE 0 END, 0)::DOUBLE"""
    if r.context:
        score = f"CASE WHEN {sql_contains_any(low, r.context)} THEN {score} ELSE 0 END"
    return score


RULE_RELEVANCE_SQL = sql_rule_rows(
    lambda r, i: f"SELECT doc_id, {q(r.rule_id)} AS rule_id, {sql_relevance('text', r)} AS relevance_score FROM documents "
    f"WHERE length(text) >= 10 AND {sql_contains_any('lower(text)', r.keywords)}"
)


# ---------------------------------------------------------------- clients of the registered queries


class RuleClient:
    """Deterministic stand-in for a model: the need is the first line of the text after the last mark."""

    def __init__(self, mark: str = "TEXT:", max_atoms: int = 3):
        self.mark, self.max_atoms = mark, max_atoms

    def __call__(self, prompts: list[str]) -> list[tuple[str | None, int, int]]:
        out: list[tuple[str | None, int, int]] = []
        for p in prompts:
            body = p.rsplit(self.mark, 1)[-1].strip()
            lines = [s for s in body.split("\n") if s.strip()][: self.max_atoms]
            reply = json.dumps({"atoms": [{"need_statement": s} for s in lines]}, ensure_ascii=False)
            out.append((reply, len(p) // 4, len(reply) // 4))
        return out


class LineClient:
    """Deterministic stand-in for a text service: the first line of the prompt body, marked."""

    def __init__(self, prefix: str = "", fail: str = ""):
        self.prefix, self.fail = prefix, fail

    def __call__(self, prompts: list[str]) -> list[tuple[str | None, int, int]]:
        return [
            (None, len(p) // 4, 0) if self.fail and self.fail in p else (self.prefix + p.split("\n")[0], len(p) // 4, 1)
            for p in prompts
        ]
