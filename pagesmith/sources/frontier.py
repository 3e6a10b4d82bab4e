"""What to fetch next: page URLs of stores, freshness of earlier fetches, extraction requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import absolute_url, url_quote, validate_url

# Model used when a request names none; lifetime of a fetched store list in seconds.
DEFAULT_MODEL = "gemini-1.5-flash"
FRESH_SECONDS = 3600


def pages_to_fetch(requested: Column, available: Column) -> Column:
    """Page count of a store: what was asked for, capped by what its pager offers."""
    return F.least(requested, available)


def store_page_urls(stores: DataFrame, base: str, encode_keyword: bool = False) -> DataFrame:
    """``store, n_pages[, keyword]`` -> one row per page number with its URL."""
    url = F.concat(
        F.lit(f"{base}/store/"), F.lower("store"), F.lit("?page="), F.col("page_number")
    )
    if "keyword" in stores.columns:
        word = url_quote(F.col("keyword")) if encode_keyword else F.col("keyword")
        has_word = F.coalesce(F.col("keyword") != "", F.lit(False))
        url = F.when(has_word, F.concat(url, F.lit("&keyword="), word)).otherwise(url)
    numbers = F.when(F.col("n_pages") > 0, F.sequence(F.lit(1), F.col("n_pages").cast("int")))
    return stores.withColumn("page_number", F.explode(numbers)).withColumn("url", url)


def search_urls(searches: DataFrame, base: str) -> DataFrame:
    """``store, keyword`` -> the in-store search URL and the global fallback URL."""
    word = url_quote(F.col("keyword"))
    return searches.withColumns(
        {
            "store_url": F.concat(
                F.lit(f"{base}/store/"), F.col("store"), F.lit("?keyword="), word
            ),
            "fallback_url": F.concat(
                F.lit(f"{base}/search?keyword="), word, F.lit("&store="), F.col("store")
            ),
        }
    )


def mark_fresh(frontier: DataFrame, fetches: DataFrame, as_of: str,
               ttl_seconds: int = FRESH_SECONDS) -> DataFrame:
    """Label each URL ``reuse`` when its last fetch before ``as_of`` is younger than the lifetime,
    else ``refetch``. Fetches are reduced to one row per URL before they are shuffled."""
    now = F.lit(as_of).cast("timestamp_ntz")
    last = (
        fetches.where(F.col("fetched_at") <= now)
        .groupBy("url")
        .agg(F.max("fetched_at").alias("last_fetch"))
    )
    fresh = F.col("last_fetch") > now - F.expr(f"INTERVAL '{int(ttl_seconds)}' SECOND")
    return frontier.join(last, "url", "left").withColumn(
        "action", F.when(fresh, "reuse").otherwise("refetch")
    )


def link_frontier(links: DataFrame) -> DataFrame:
    """Links of a container (``url, name, href``) -> pages to fetch, keyed by the link's text."""
    return links.select(
        F.col("url").alias("found_on"),
        "position",
        "name",
        absolute_url(F.col("url"), F.col("href")).alias("url"),
    )


def check_requests(requests: DataFrame, pricing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) of ``url, fields, model``: the model gets its default; an invalid URL,
    an empty field list or a model without a price is refused, with the first reason that holds.

    ``pricing`` comes from ``pricing_table`` and so has a checked, small size."""
    known = F.broadcast(pricing.select(F.col("model"), F.lit(True).alias("known_model")))
    checked = (
        requests.withColumn("model", F.coalesce("model", F.lit(DEFAULT_MODEL)))
        .join(known, "model", "left")
        .withColumn("url_check", validate_url(F.col("url")))
        .withColumn(
            "reason",
            F.when(~F.col("url_check.ok"), F.concat(F.lit("url_"), F.col("url_check.reason")))
            .when(F.coalesce(F.size("fields"), F.lit(0)) < 1, "no_fields")
            .when(F.col("known_model").isNull(), "unsupported_model"),
        )
        .drop("url_check", "known_model")
    )
    return (
        checked.where(F.col("reason").isNull()).drop("reason"),
        checked.where(F.col("reason").isNotNull()),
    )
