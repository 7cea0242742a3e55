"""Enrichment jobs around a caller-supplied model client.

A client factory is opened once per partition and answers batches of prompts:
``client(list[str]) -> list[(text or None, prompt_tokens, completion_tokens)]``.
Replies are stored before anything else reads them, so a retried or recomputed stage downstream never asks
(and pays) again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import col
from ..session import cut, scratch_path
from . import aggregates as A
from .graph import connected_components
from .joins import left_join_translation, resume_anti_join
from .ranking import number_rows, top_k

Reply = tuple[str | None, int, int]
Client = Callable[[list[str]], list[Reply]]
ClientFactory = Callable[[], Client]


# ---------------------------------------------------------------- prompts


def render_prompt(template: str, values: Mapping[str, Column]) -> Column:
    """Fill ``{name}`` places of a literal template from columns; nulls become empty.

    The template is cut at its places first, so braces inside values never act as places.
    """
    bits: list[Column] = []
    rest = template
    while True:
        at = min(((rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest), default=None)
        if at is None:
            break
        pos, name = at
        bits += [F.lit(rest[:pos]), F.coalesce(values[name].cast("string"), F.lit(""))]
        rest = rest[pos + len(name) + 2 :]
    return F.concat(*bits, F.lit(rest))


def atom_prompt(template: str, forum: str, unknown: str = "unknown", cap: int = 1500) -> Column:
    """Prompt of a candidate row: product (app, else story title), perspective by source, capped text."""
    app = F.when(F.col("app_name") != "", F.col("app_name"))
    story = F.when(F.col("story_title") != "", F.substring("story_title", 1, 50))
    return render_prompt(
        template,
        {
            "source": F.col("source"),
            "product": F.coalesce(app, story, F.lit(unknown)),
            "weight": F.col("weight_signal"),
            "perspective": F.when(F.col("source") == forum, "tech").otherwise("consumer"),
            "content": F.substring("content", 1, cap),
        },
    )


def numbered_statements(
    members: DataFrame, by: Sequence[str], statement: str, weight: str, row_id: str, n: int = 8, strongest_first: bool = True
) -> DataFrame:
    """The ``n`` first statements per group by weight, as numbered lines for a prompt."""
    order = F.desc(weight) if strongest_first else F.asc(weight)
    top = top_k(members, by, [order, F.col(row_id)], n, "_r")
    line = F.concat(F.col("_r").cast("string"), F.lit(". "), F.col(statement))
    packed = F.array_sort(F.collect_list(F.struct("_r", line.alias("x"))))
    return top.groupBy(*by).agg(F.array_join(F.transform(packed, lambda e: e["x"]), "\n").alias("statements"))


# ---------------------------------------------------------------- calls


def with_retry(client: Client, tries: int = 3, pause: float = 2.0) -> Client:
    """Ask again on an exception, waiting ``pause`` seconds longer each time; then null replies."""

    def ask(prompts: list[str]) -> list[Reply]:
        for k in range(tries):
            try:
                return client(prompts)
            except Exception:  # noqa: BLE001 - any client error counts as a failed try
                if k + 1 < tries:
                    time.sleep(pause * (k + 1))
        return [(None, 0, 0)] * len(prompts)

    return ask


def with_fallback(clients: Sequence[Client]) -> Client:
    """Ask clients in order for the prompts that have no reply yet; tokens add up."""

    def ask(prompts: list[str]) -> list[Reply]:
        out: list[Reply] = [(None, 0, 0)] * len(prompts)
        for c in clients:
            open_ = [i for i, r in enumerate(out) if not r[0]]
            if not open_:
                break
            for i, (t, p, k) in zip(open_, c([prompts[i] for i in open_])):
                out[i] = (t, out[i][1] + p, out[i][2] + k)
        return out

    return ask


def as_they_arrive(call: Callable, todo: Iterator, in_flight: int) -> Iterator:
    """Results of ``call`` on every item, with at most ``in_flight`` calls open; items are taken as calls end."""
    if in_flight <= 1:
        yield from map(call, todo)
        return
    with ThreadPoolExecutor(in_flight) as pool:
        open_ = {pool.submit(call, item) for item in islice(todo, in_flight)}
        while open_:
            done, open_ = wait(open_, return_when=FIRST_COMPLETED)
            open_ |= {pool.submit(call, item) for item in islice(todo, len(done))}
            for f in done:
                yield f.result()


def infer_batches(
    prompts: DataFrame,
    row_id: str,
    prompt: str,
    factory: ClientFactory,
    workers: int,
    path: str | None = None,
    batch: int = 64,
    tries: int = 3,
    pause: float = 2.0,
    slice_rows: int = 2000,
    in_flight: int = 1,
) -> DataFrame:
    """Ask the client for every row, in waves of ``workers`` tasks with about ``slice_rows`` rows each.

    A task keeps up to ``in_flight`` calls of ``batch`` prompts open and passes replies on as they arrive, so a slow reply holds up no other
    (the client must bear calls from several threads then); ``workers * in_flight`` bounds the concurrent calls.  Each wave is written to ``path`` (a
    new scratch table by default) when it is done, so a lost executor costs one slice and a lost run one wave, however many rows
    there are.  Read back: (row_id, reply, prompt_tokens, completion_tokens).
    """
    idt = prompts.schema[row_id].dataType
    schema = T.StructType(
        [
            T.StructField(row_id, idt),
            T.StructField("reply", T.StringType()),
            T.StructField("prompt_tokens", T.LongType()),
            T.StructField("completion_tokens", T.LongType()),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = with_retry(factory(), tries, pause)

        def call(part: pd.DataFrame) -> pd.DataFrame:
            got = client(part[prompt].tolist())
            return pd.DataFrame(
                {
                    row_id: part[row_id].to_numpy(),
                    "reply": [g[0] for g in got],
                    "prompt_tokens": [g[1] for g in got],
                    "completion_tokens": [g[2] for g in got],
                }
            )

        todo = (pdf.iloc[at : at + batch] for pdf in batches for at in range(0, len(pdf), batch))
        yield from as_they_arrive(call, todo, in_flight)

    spark = prompts.sparkSession
    target = path or scratch_path(spark, "replies")
    rows = prompts.select(row_id, prompt)
    waves = max(1, -(-rows.count() // (workers * slice_rows)))
    for wave in range(waves):
        part = rows.filter(F.pmod(F.xxhash64(row_id, F.lit("wave")), F.lit(waves)) == wave) if waves > 1 else rows
        part.repartition(workers, row_id).mapInPandas(run, schema).write.mode("append").parquet(target)
    return spark.read.schema(schema).parquet(target)


def resume_infer(
    todo: DataFrame, row_id: str, prompt: str, factory: ClientFactory, workers: int, path: str, **options
) -> DataFrame:
    """Ask only for rows without a stored reply at ``path`` and return all stored replies."""
    spark = todo.sparkSession
    try:
        done = spark.read.parquet(path).filter(F.col("reply").isNotNull())
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return infer_batches(todo, row_id, prompt, factory, workers, path, **options)
    open_ = cut(resume_anti_join(todo.select(row_id, prompt), done, row_id))
    everything = infer_batches(open_, row_id, prompt, factory, workers, path, **options)
    # A failed row may have an older null reply beside its new one.
    return everything.groupBy(row_id).agg(
        F.max("reply").alias("reply"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens")
    )


# ---------------------------------------------------------------- replies

ATOM_REPLY = "struct<atoms:array<string>>"
LABEL_REPLY = (
    "title string, description string, demand_type string, demand_tier int, ai_score int, "
    "ai_intervention_type string, ai_description string, ai_keywords array<string>, "
    "semantic_fingerprint string, is_meaningful boolean"
)


def strip_fences(reply: Column | str) -> Column:
    """The inside of a fenced block if there is one, else the whole reply."""
    s = F.coalesce(col(reply), F.lit(""))
    inner = F.regexp_extract(s, r"(?s)```(?:json)?\s*(.*?)```", 1)
    return F.trim(F.when(inner != "", inner).otherwise(s))


def parsed_or_error(reply: Column | str, schema: str) -> Column:
    """struct(value, error): the parsed reply, or an error text when it is no JSON object."""
    body = strip_fences(reply)
    ok = body.startswith("{") & F.try_parse_json(body).isNotNull()
    return F.struct(
        F.when(ok, F.from_json(body, schema)).alias("value"),
        F.when(~ok, F.lit("no JSON object")).alias("error"),
    )


def parse_atoms(replies: DataFrame, row_id: str, reply: str, product: str, default_type: str = "problem") -> DataFrame:
    """Need atoms of JSON replies ``{"atoms": [{need_statement, product, feature, sentiment, type}]}``.

    Anything that is not such an object gives none.  Items without a statement drop, but keep their
    number: ids count positions before the drop.
    """
    body = F.col(reply)
    good = body.startswith("{") & F.try_parse_json(body).isNotNull()
    items = F.from_json(F.when(good, body), ATOM_REPLY)["atoms"]
    fields = "need_statement string, product string, feature string, sentiment string, type string"
    rows = replies.select("*", F.posexplode(items).alias("_p", "_raw"))
    rows = rows.withColumn("_a", F.when(F.col("_raw").startswith("{"), F.from_json("_raw", fields)))
    rows = rows.filter(F.coalesce(F.col("_a.need_statement"), F.lit("")) != "")
    return rows.select(
        *replies.columns,
        F.concat(F.col(row_id).cast("string"), F.lit("_a"), (F.col("_p") + 1).cast("string")).alias("atom_id"),
        F.trim("_a.need_statement").alias("need_statement"),
        F.coalesce(F.col("_a.product"), F.col(product)).alias("atom_product"),
        F.trim(F.coalesce("_a.feature", F.lit(""))).alias("feature"),
        F.coalesce("_a.sentiment", F.lit("neutral")).alias("sentiment"),
        F.coalesce("_a.type", F.lit(default_type)).alias("type"),
    )


def parse_labels(clusters: DataFrame, reply: str, only_meaningful: bool = False) -> DataFrame:
    """Cluster rows with their label struct; replies without a title drop."""
    body = F.col(reply)
    good = body.startswith("{") & F.try_parse_json(body).isNotNull()
    out = clusters.withColumn("_l", F.from_json(F.when(good, body), LABEL_REPLY))
    out = out.filter(F.coalesce(F.col("_l.title"), F.lit("")) != "")
    if only_meaningful:
        out = out.filter(F.coalesce(F.col("_l.is_meaningful"), F.lit(True)))
    return out.select(*[c for c in clusters.columns if c != reply], "_l.*")


def apply_merge_decisions(groups: DataFrame, decisions: DataFrame, group: str, item: str, local: str) -> DataFrame:
    """Output of merge decisions over candidate groups.

    ``groups``: (group, item, local) with 0-based local positions, singles not included; ``decisions``: (group,
    should_merge, merge_groups array<struct<merged_title, cluster_indices, ...>>, exclude_indices array<int>).

    Yields (out_id, kind, item, merged_title, ord, overrides, times): each merge group is one output with several items, in the order
    ``ord`` of its indices; excluded ones, items of groups not to merge, undecided groups and items no group names each stay
    alone.  Positions out of range are ignored.  As published, an item named by two merge groups appears in
    both; ``times`` tells.  ``overrides`` is the merge group's entry.  Every item is classified in one pass.
    """
    entries = decisions.filter("should_merge").select(group, F.posexplode("merge_groups").alias("_g", "_m"))
    named = (
        entries.select(group, "_g", "_m", F.posexplode("_m.cluster_indices").alias("_p", local))
        .groupBy(group, local, "_g").agg(F.min("_p").alias("ord"), F.first("_m").alias("overrides"))
        .groupBy(group, local).agg(F.array_sort(F.collect_list(F.struct("_g", "ord", "overrides"))).alias("_in"))
    )
    yes = decisions.select(group, "should_merge", F.coalesce("exclude_indices", F.array().cast("array<int>")).alias("_x"))
    rows = groups.join(yes, group, "left").join(named, [group, local], "left")
    rows = rows.withColumn("times", F.greatest(F.coalesce(F.size("_in"), F.lit(0)), F.lit(1)).cast("bigint")).select("*", F.explode_outer("_in").alias("_one"))
    alone = (
        F.when(F.col("should_merge").isNull(), "undecided")
        .when(~F.col("should_merge"), "kept")
        .when(F.array_contains("_x", F.col(local)), "excluded")
        .otherwise("unnamed")
    )
    merged = F.col("_one").isNotNull()
    return rows.select(
        item,
        F.when(merged, F.concat_ws("/", F.col(group).cast("string"), F.col("_one._g").cast("string"))).otherwise(F.col(item).cast("string")).alias("out_id"),
        F.when(merged, "merged").otherwise(alone).alias("kind"),
        F.col("_one.overrides.merged_title").alias("merged_title"),
        F.col("_one.ord").alias("ord"),
        F.col("_one.overrides").alias("overrides"),
        "times",
    )


def merged_fields(decided: DataFrame, items: DataFrame, item: str, fields: Sequence[str], means: Sequence[str] = ()) -> DataFrame:
    """One row per output of :func:`apply_merge_decisions`: (out_id, kind, members, fields, means).

    A field is the merge group's ``merged_<field>`` if it is given, else the first member's; one of ``means`` falls back to the rounded
    mean of all members.  ``items`` has the fields of every item.
    """
    given = set(decided.schema["overrides"].dataType.fieldNames())
    rows = decided.join(items.select(item, *fields, *means), item)
    first = F.struct(F.coalesce("ord", F.lit(0)).alias("o"), F.col(item).alias("i"))

    def value(name: str, fallback: Column) -> Column:
        own = f"merged_{name}"
        return (F.coalesce(F.max(f"overrides.{own}"), fallback) if own in given else fallback).alias(name)

    return rows.groupBy("out_id", "kind").agg(
        F.count(F.lit(1)).alias("members"),
        *[value(f, F.min_by(f, first)) for f in fields],
        *[value(f, F.bround(F.avg(f)).cast(items.schema[f].dataType)) for f in means],
    )


def overlapping_batches(rows: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Windows of ``n`` rows, plus the same shifted by half a window, for pairwise review.

    Shifted windows of a single row are left out.  Adds ``batch`` (text) and ``local`` (0-based).
    """
    half = n // 2
    r = number_rows(rows, by, order, "_n").withColumn("_z", F.col("_n") - 1)
    total = r.groupBy(*by).agg(F.max("_n").alias("_total")) if by else None
    straight = r.select(
        *rows.columns, F.concat(F.lit("a"), F.floor(F.col("_z") / n).cast("string")).alias("batch"), (F.col("_z") % n).cast("int").alias("local")
    )
    late = r.filter(F.col("_z") >= half)
    if by:
        late = late.join(total, list(by))
    else:
        late = late.withColumn("_total", F.lit(r.count()))
    slot = F.floor((F.col("_z") - half) / n)
    size = F.least(F.lit(n), F.col("_total") - half - slot * n)
    crossed = late.filter(size >= 2).select(
        *rows.columns, F.concat(F.lit("b"), slot.cast("string")).alias("batch"), ((F.col("_z") - half) % n).cast("int").alias("local")
    )
    return straight.unionByName(crossed)


def dedupe_groups(items: DataFrame, item: str, suggestions: DataFrame, members: str) -> DataFrame:
    """Items with the ``root`` of their merged group: groups suggested by different batches join where
    they share items, and the root is the lowest id of the connected part."""
    from .clustering import group_edges

    comp = connected_components(group_edges(suggestions, members)).withColumnRenamed("component", "root")
    out = items.join(comp.withColumnRenamed("node", item), item, "left")
    return out.withColumn("root", F.coalesce("root", item))


def group_notes(grouped: DataFrame, item: str, suggestions: DataFrame, members: str, reason: str) -> DataFrame:
    """The reasons of the suggestions behind each root, one row each in order of their first item: (root, ord, note)."""
    first = suggestions.filter(F.size(members) >= 2).select(F.get(F.col(members), 0).alias(item), F.col(reason).alias("note"))
    return number_rows(first.join(grouped.select(item, "root"), item), ["root"], [F.col(item), F.col("note")], "ord").select("root", "ord", "note")


def refine_field(rows: DataFrame, field: str, reply: str) -> DataFrame:
    """Replace ``field`` by a non-empty reply and keep the old text in ``original_<field>``."""
    new = F.trim(F.coalesce(F.col(reply), F.lit("")))
    return rows.withColumns(
        {f"original_{field}": F.col(field), field: F.when(new != "", new).otherwise(F.col(field)), "refined": new != ""}
    ).drop(reply)


def translate_missing(
    comments: DataFrame,
    done: DataFrame,
    good: Column,
    recent: Column,
    factory: ClientFactory,
    workers: int,
    char_class: str,
    content: str = "content",
    path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Translate recent, good comments that have no translation yet.

    ``done``: (id, content_zh) of earlier runs.  Yields (comments with ``content_out``, one-row counts).
    """
    wanted = comments.filter(recent & good).select("id", content)
    todo = resume_anti_join(wanted, done, "id")
    replies = infer_batches(todo, "id", content, factory, workers, path, pause=0.0)
    all_tr = done.select("id", "content_zh").unionByName(replies.select("id", F.col("reply").alias("content_zh")).filter("content_zh is not null"))
    out = left_join_translation(wanted, all_tr, content, "content_zh", char_class)
    counts = replies.agg(
        F.count(F.lit(1)).alias("asked"), F.count("reply").alias("translated"), F.count_if(F.col("reply").isNull()).alias("failed")
    )
    return out, counts


# ---------------------------------------------------------------- embeddings


def embed_text_client(rows: DataFrame, text: str, out: str, factory: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]], batch: int = 64) -> DataFrame:
    """Vectors from a client opened once per partition."""
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for pdf in batches:
            vecs: list[list[float]] = []
            for at in range(0, len(pdf), batch):
                vecs += [list(map(float, v)) for v in client(pdf[text].iloc[at : at + batch].tolist())]
            yield pdf.assign(**{out: vecs})

    return rows.mapInPandas(run, schema)


def embed_text_stored(
    rows: DataFrame, text: str, out: str, factory: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]], store: str, batch: int = 64
) -> DataFrame:
    """``rows`` with vectors kept at ``store`` by the digest of their text: only texts that no earlier run embedded go to the client, copies once.

    A null text is embedded as the empty one.
    """
    from ..sources.published import exists

    spark = rows.sparkSession
    schema = "text_key string, vec array<double>"
    keyed = rows.withColumn("_text", F.coalesce(F.col(text), F.lit(""))).withColumn("_key", F.sha2("_text", 256))
    asked = keyed.groupBy(F.col("_key").alias("text_key")).agg(F.min("_text").alias("text"))
    if exists(spark, store):
        asked = asked.join(spark.read.schema(schema).parquet(store), "text_key", "left_anti")
    embed_text_client(asked, "text", "vec", factory, batch).select("text_key", "vec").write.mode("append").parquet(store)
    # Two runs at once may both have embedded a text.
    vectors = spark.read.schema(schema).parquet(store).groupBy("text_key").agg(F.min("vec").alias(out))
    return keyed.join(vectors.withColumnRenamed("text_key", "_key"), "_key").select(*rows.columns, out)


def embed_text_tfidf(rows: DataFrame, text: str, out: str, n: int = 3, dims: int = 256, carry: list[str] | None = None) -> DataFrame:
    """Unit vectors from hashed character n-grams weighted by inverse document frequency, beside the columns ``carry`` of ``rows`` (by default all)."""
    from pyspark.ml.feature import IDF, HashingTF, NGram, Normalizer
    from pyspark.ml.functions import vector_to_array

    base = rows.withColumn("_chars", F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), ""))
    grams = NGram(n=n, inputCol="_chars", outputCol="_grams").transform(base)
    kept = rows.columns if carry is None else carry
    # Counted once for the document frequencies and the vectors; only counts are kept.
    tf = cut(HashingTF(numFeatures=dims, inputCol="_grams", outputCol="_tf").transform(grams).select(*kept, "_tf"))
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(tf).transform(tf)
    unit = Normalizer(inputCol="_idf", outputCol="_unit").transform(idf)
    return unit.withColumn(out, vector_to_array("_unit")).select(*kept, out)


def usage(replies: DataFrame, results: str) -> DataFrame:
    """Token usage and cost of stored replies."""
    return A.token_cost(replies, "prompt_tokens", "completion_tokens", results)
