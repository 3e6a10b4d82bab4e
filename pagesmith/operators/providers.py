"""Extraction providers: something that turns a prompt or chunk into JSON text.

Two rule providers work offline as Spark expressions. A real model is any Python callable; it is
run by ``mapInPandas`` over all chunks in parallel and its failures become rows, not job failures.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import cut_lineage, salted_lookup
from ..functions.tokens import TokenCounter, count_tokens

Reply = tuple[str | None, int, int]
Provider = Callable[[str], Reply]


def _record(values: dict[str, Column]) -> Column:
    return F.struct(*[v.alias(name) for name, v in values.items()])


def link_rule_reply(text: Column, fields: Sequence[str]) -> Column:
    """Every ``[name](target)`` is a record: first field = name, second field = target."""
    found = F.regexp_extract_all(text, F.lit(r"\[([^\]\[]*)\]\(([^)]*)\)"), F.lit(0))

    def record(link: Column) -> Column:
        parts = [
            F.regexp_extract(link, r"^\[([^\]]*)\]", 1),
            F.regexp_extract(link, r"\]\(([^)]*)\)$", 1),
        ]
        return _record(dict(zip(fields, parts)))

    return F.to_json(F.struct(F.transform(found, record).alias("listings")))


def pair_rule_reply(text: Column, fields: Sequence[str]) -> Column:
    """One record from ``field: value`` lines; a field without a line is left out of the JSON."""

    def value(field: str) -> Column:
        hit = F.regexp_extract(text, rf"(?im)^[ \t*]*\Q{field}\E[ \t]*:[ \t]*(.*?)[ \t]*$", 1)
        return F.when(hit != "", hit)

    found = {f: value(f) for f in fields}
    some = F.coalesce(*found.values()).isNotNull()
    rows = F.filter(F.array(_record(found)), lambda _: some)
    return F.to_json(F.struct(rows.alias("listings")))


def rule_replies(prompts: DataFrame, fields: Sequence[str], rule=link_rule_reply,
                 counter: TokenCounter = count_tokens) -> DataFrame:
    """Replies of an offline rule: adds ``reply, input_tokens, output_tokens, error``."""
    with_reply = prompts.withColumn("reply", rule(F.col("text"), fields))
    return with_reply.withColumns(
        {
            "input_tokens": counter(F.col("prompt")),
            "output_tokens": counter(F.col("reply")),
            "error": F.lit(None).cast("string"),
        }
    )


def call_provider(prompts: DataFrame, provider: Provider, retries: int = 2,
                  tasks: int | None = None, wait: float = 0.5) -> DataFrame:
    """Replies of a Python callable ``prompt -> (json, input_tokens, output_tokens)``.

    A call that still raises after its retries yields a row with ``error`` set, so that one failing
    chunk never stops the others. A retry comes after ``wait`` seconds, the next after twice that.
    ``tasks`` sets how many calls are in flight at most. Of the texts only the prompt goes to Python and
    neither comes back. Checkpoint the result before using it twice."""
    prompts = prompts.drop("text")
    added = [("reply", T.StringType()), ("input_tokens", T.LongType()),
             ("output_tokens", T.LongType()), ("error", T.StringType())]
    names = [name for name, _ in added]
    kept = [f for f in prompts.schema.fields if f.name != "prompt"]
    schema = T.StructType(kept + [T.StructField(n, t) for n, t in added])

    def ask(prompt: str) -> tuple[str | None, int, int, str | None]:
        problem = ""
        for attempt in range(retries + 1):
            if attempt:
                time.sleep(wait * 2 ** (attempt - 1))
            try:
                return (*provider(prompt), None)
            except Exception as exc:  # noqa: BLE001 - any failure becomes an error row
                problem = f"{type(exc).__name__}: {exc}"
        return None, 0, 0, problem

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [ask(p) for p in batch["prompt"]]
            yield batch.drop(columns="prompt").assign(**{n: [a[i] for a in answers] for i, n in enumerate(names)})

    spread_out = prompts if tasks is None else prompts.repartition(tasks)
    return spread_out.mapInPandas(run, schema)


def ask_once(prompts: DataFrame, ask: Callable[[DataFrame], DataFrame], stored: DataFrame | None = None) -> DataFrame:
    """Replies for all prompts, each distinct (prompt, model) asked once and those in ``stored`` not at
    all. ``stored`` has ``prompt_key`` and the reply columns, as ``reply_table`` gives them.

    Only keys and replies are joined back, over salted keys, as boilerplate prompts repeat very often."""
    key = F.sha2(F.concat_ws(" ", F.coalesce("model", F.lit("")), "prompt"), 256)
    keyed = prompts.withColumn("prompt_key", key)
    fresh = keyed.groupBy("prompt_key").agg(*[F.first(c).alias(c) for c in ("model", "text", "prompt")])
    if stored is not None:
        fresh = fresh.join(stored.select("prompt_key"), "prompt_key", "left_anti")
    replies = reply_table(cut_lineage(ask(fresh)))
    known = replies if stored is None else replies.unionByName(stored.select(*replies.columns).dropDuplicates(["prompt_key"]))
    return salted_lookup(keyed, known, "prompt_key").drop("prompt_key")


def reply_table(answered: DataFrame) -> DataFrame:
    """``prompt_key`` and reply columns, to be stored and passed to a later :func:`ask_once`."""
    return answered.select("prompt_key", "reply", "input_tokens", "output_tokens", "error")


def split_known(prompts: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answered, open) prompts against stored replies keyed by ``prompt_hash, model``, so that a
    re-run only pays for prompts it has not seen."""
    keyed = prompts.withColumn("prompt_hash", F.sha2("prompt", 256))
    keys = ["prompt_hash", "model"]
    answers = stored.dropDuplicates(keys)
    return keyed.join(answers, keys), keyed.join(answers.select(*keys), keys, "left_anti")
