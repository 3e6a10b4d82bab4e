"""Joins that complete records: featured projects, store lookups, search with a fallback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import salted_lookup
from ..functions.html import has_element, to_text
from ..functions.text import keyword_match, preview
from ..functions.urls import url_slug
from .cards import DEAL_SEARCH_CARD, CardSpec, deal_cards

# Fixed value: how many featured projects are enriched.
FEATURED_LIMIT = 5


def enrich_featured(projects: DataFrame, pages: DataFrame, limit: int = FEATURED_LIMIT,
                    chars: int = 1000) -> DataFrame:
    """Attach a text preview of the linked page to the first project of each of the first
    ``limit`` featured URLs. Of a URL stored more than once the page with the largest id counts, so
    every broadcast side has at most ``limit`` rows."""
    chosen = (
        projects.where(F.col("featured") & (F.col("url") != ""))
        .orderBy("page_id", "position")
        .limit(limit)
        .select("url")
        .distinct()
    )
    first = F.min(F.struct("page_id", "position")).alias("at")
    holders = projects.join(F.broadcast(chosen), "url").groupBy("url").agg(first)
    stored = pages.select("url", "html", F.col("page_id").alias("_stored")).join(F.broadcast(holders), "url")
    latest = stored.groupBy("url", "at").agg(F.max_by("html", "_stored").alias("html"))  # a URL may be stored again
    texts = latest.select(
        F.col("at.page_id").alias("page_id"), F.col("at.position").alias("position"),
        preview(to_text(F.col("html")), chars).alias("detailed_content"),
    )
    return projects.join(F.broadcast(texts), ["page_id", "position"], "left")


def sample_head(rows: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """The first ``n`` records in order, numbered from 1."""
    head = rows.orderBy(*order).limit(n)
    return head.withColumn("number", F.row_number().over(Window.orderBy(*order)))


def store_lookup(selections: DataFrame, stores: DataFrame) -> DataFrame:
    """Slug of the first store (by ``position``) whose name equals the selection; NULL if none.

    Stores are reduced to one row per name first; hot names are salted."""
    first = stores.groupBy("name").agg(F.min_by("url", "position").alias("store_url"))
    found = salted_lookup(selections, first, "name")
    return found.withColumn("slug", url_slug(F.col("store_url"))).drop("store_url")


def search_with_fallback(searches: DataFrame, primary: DataFrame, fallback: DataFrame,
                         spec: CardSpec = DEAL_SEARCH_CARD) -> DataFrame:
    """Cards of each (store, keyword) search whose name holds the keyword, from pages with ``html``.
    The global search is used only where the in-store pages show no card at all (matching or not).

    Whether a page shows a card is a test of its start tags; cards are read once, and only from pages
    that count: the in-store pages asked for, and the global pages of searches that missed."""
    keys = ["store", "keyword"]
    asked = searches.select(*keys).distinct()
    shown = primary.where(has_element(F.col("html"), spec.tag, spec.cls))
    missed = asked.join(shown.select(*keys).distinct(), keys, "left_anti")
    rows = deal_cards(shown.join(asked, keys, "left_semi"), spec).withColumn("origin", F.lit("store"))
    rest = deal_cards(fallback.join(missed, keys, "left_semi"), spec).withColumn("origin", F.lit("global"))
    return rows.unionByName(rest).where(keyword_match(F.col("product_name"), F.col("keyword")))
