"""Harvest job: deal cards of the fetched pages that belong to the stores' frontier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import url_page_number
from ..operators.cards import DEAL_ATTR_CARD, CardSpec, deal_cards
from ..sources.frontier import store_page_urls
from ..sources.pages import split_by_status


def harvest_store_deals(stores: DataFrame, pages: DataFrame, base: str,
                        spec: CardSpec = DEAL_ATTR_CARD) -> tuple[DataFrame, DataFrame]:
    """(products, rejects): cards of every frontier page, with ``(store, page, position)`` to order
    them by. Frontier URLs without a usable page are rejects.

    Cards are read on the page scan, before the join on the URL, so HTML is never shuffled."""
    frontier = store_page_urls(stores, base).select("store", "url")
    good, failed = split_by_status(pages)
    products = deal_cards(good, spec).join(frontier, "url")
    labelled = products.withColumn("page_number", url_page_number(F.col("url")))
    missing = frontier.join(good.select("url").distinct(), "url", "left_anti").select("url")
    reasons = failed.select("url", "reason").dropDuplicates(["url"])
    rejects = missing.join(reasons, "url", "left").withColumn(
        "reason", F.coalesce("reason", F.lit("not_fetched"))
    )
    return labelled, rejects
