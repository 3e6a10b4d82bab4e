"""Extraction job: fetched pages -> markdown -> chunks -> replies -> merged, priced listings."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..cluster import cut_lineage
from ..functions.chunks import CHUNK_OVERLAP, CHUNK_SIZE
from ..functions.html import to_markdown
from ..functions.text import strip_urls
from ..functions.tokens import MAX_TOKENS, trim_to_tokens
from ..operators import listings as L
from ..operators.pricing import price_runs
from ..operators.providers import rule_replies
from ..operators.runs import listing_records, run_id, store_runs


@dataclass(frozen=True)
class Extraction:
    """Result tables of one job; each is a DataFrame that nothing has been collected from."""

    parsed: DataFrame  # one row per chunk: status, listings, tokens
    listings: DataFrame  # merged listings
    totals: DataFrame  # one row per run: chunk, record and token counts, cost
    unpriced: DataFrame  # pages refused before any call, as their model has no price
    failed: DataFrame  # chunks that gave nothing, with the reason


@dataclass(frozen=True)
class Options:
    chunk_size: int = CHUNK_SIZE
    chunk_overlap: int = CHUNK_OVERLAP
    drop_urls: bool = False
    max_tokens: int | None = None
    repair_json: bool = False
    array_fields: tuple[str, ...] = ()

    @staticmethod
    def token_limited() -> Options:
        return Options(max_tokens=MAX_TOKENS)


def page_markdown(pages: DataFrame, options: Options = Options()) -> DataFrame:
    """``scrape_id, text`` (and ``model`` if given) of a page table; ``page_id`` names the run."""
    text = to_markdown(F.col("html"))
    if options.drop_urls:
        text = strip_urls(text)
    if options.max_tokens is not None:
        text = trim_to_tokens(text, options.max_tokens)
    kept = [c for c in ("model",) if c in pages.columns]
    return pages.select(F.col("page_id").alias("scrape_id"), *kept, text.alias("text"))


def page_prompts(pages: DataFrame, fields: Sequence[str], options: Options = Options()) -> DataFrame:
    """``scrape_id, chunk_idx, text, prompt`` of a page table."""
    chunks = L.chunk_rows(page_markdown(pages, options), options.chunk_size, options.chunk_overlap)
    return L.build_prompts(chunks, fields)


def accepted_pages(pages: DataFrame, model: str | None, pricing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages whose model has a price, refused runs). Pages without a ``model`` column use ``model``."""
    if "model" not in pages.columns:
        pages = pages.withColumn("model", F.lit(model).cast("string"))
    known = F.broadcast(pricing.select("model"))  # at most MAX_MODELS rows
    refused = pages.select(F.col("page_id").alias("scrape_id"), "model").join(known, "model", "left_anti")
    return pages.join(known, "model", "left_semi"), refused.withColumn("reason", F.lit("unsupported_model"))


def extract_pages(pages: DataFrame, fields: Sequence[str], model: str | None, pricing: DataFrame,
                  reply: Callable[[DataFrame], DataFrame] | None = None,
                  options: Options = Options()) -> Extraction:
    """Run the job. ``reply`` maps prompt rows to reply rows (default: the offline link rule).
    All pages use ``model``, or each its own when the page table has a ``model`` column; models
    without a price are refused before anything is asked.

    Parsed replies are checkpointed once: pages are read, converted and sent to the provider a
    single time, and the result tables are computed from the small checkpoint."""
    ask = reply or (lambda prompts: rule_replies(prompts, fields))
    accepted, refused = accepted_pages(pages, model, pricing)
    answered = ask(page_prompts(accepted, fields, options)).drop("text", "prompt")
    parsed = L.parse_replies(answered, fields, options.repair_json, options.array_fields)
    parsed = cut_lineage(L.fill_listings(parsed, fields, options.array_fields))
    merged = L.merge_listings(L.flatten_listings(parsed, fields), fields)
    totals, _ = price_runs(L.run_counts(parsed, ("scrape_id", "model")), pricing)
    return Extraction(parsed, merged, totals, refused, L.failed_chunks(parsed))


def store_extraction(folder: str, batch_id: str, pages: DataFrame, result: Extraction, fields: Sequence[str],
                     started_at: Column, model: str | None, pricing: DataFrame, options: Options = Options()) -> None:
    """Store a job's runs below ``folder``: metadata with raw and markdown text, listings, token rows.

    A run's id is made of its URL, page and start, so the same batch stored again has the same ids."""
    accepted, _ = accepted_pages(pages, model, pricing)
    key = run_id(F.concat_ws("#", "url", "page_id"), started_at)
    day = F.to_date(started_at).alias("run_date")
    metadata = accepted.select(
        key.alias("id"), "url", started_at.alias("timestamp"), F.col("html").alias("raw_data"),
        to_markdown(F.col("html")).alias("markdown_data"), F.col("model").alias("model_used"), day,
    )
    ids = accepted.select(F.col("page_id").alias("scrape_id"), key.alias("id"), day)
    records = listing_records(result.listings, fields).join(ids, "scrape_id")
    listings = records.select(F.col("id").alias("scrape_id"), "seq", "data", "run_date")
    costs = result.totals.join(ids, "scrape_id").select(
        F.col("id").alias("scrape_id"), "input_tokens", "output_tokens", F.col("cost").alias("total_cost"),
        F.col("model").alias("model_name"), "run_date",
    )
    store_runs(folder, batch_id, metadata, listings, costs)


def response_records(result: Extraction, fields: Sequence[str]) -> DataFrame:
    """Nested response rows: ``data``, ``tokens``, ``cost``, ``model`` (``part`` 0 for small runs)."""
    parts = L.response_parts(result.listings, fields)
    tokens = F.struct("input_tokens", "output_tokens").alias("tokens")
    totals = result.totals.select(
        "scrape_id", tokens, F.col("cost").cast("double").alias("cost"), "model"
    )
    empty = F.array().cast(parts.schema["data"].dataType)
    return totals.join(parts, "scrape_id", "left").select(
        "scrape_id",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("data", empty).alias("data"),
        "tokens", "cost", "model",
    )
