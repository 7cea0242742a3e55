from __future__ import annotations

import random

import pytest

WORDS = "the river stone lamp gras ñandú été über 数据 walk green <b> x1 -- don't A.B ZEBRA zebra".split()


def make_texts() -> list[tuple[int | None, str | None]]:
    """Texts with every case that operators must take: nulls, empty, long, repeated and shared passages, odd bytes."""
    r = random.Random(3)
    say = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    shared = say(60)
    base = say(300)
    near = base.split(" ")
    near[150] = "changed"
    texts: list[str | None] = [
        None, "", " ", "\n\n", "one", "a b c", say(40), say(40), base, base, " ".join(near), shared + " " + say(90), say(50) + "\n" + shared,
        "ab" * 400, "x" * 700, "\t tabs\tand\r\nlines \n" * 30, "<|endoftext|> in <|endoftext|>text", "wide   spaces \n here  ", " ends with spaces  ", say(9000),
        "same line here\n" * 40, "!!! ### $$$ %%%" * 20, "  odd space \x1c sep\x85 next", "née Ünïcode 数据处理 🙂🙂 ok", "idiot and moron, you loser!", "THE RIVER Stone lamp", "the river stone lamp",
    ]
    rows: list[tuple[int | None, str | None]] = list(enumerate(texts))
    rows += [(8, base), (3, say(30)), (None, say(200)), (None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The texts with columns whose names operators use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, doc string, c0 int, node long, score double, matches string, spans string"
    langs = ["en", "de", None]
    data = [(i, t, langs[k % 3], "s", None if t is None else len(t), "k", "d", k, k, 0.5, "m", "p") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
