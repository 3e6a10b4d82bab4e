"""Repeated cards on a page -> rows. What to look for is data: a :class:`CardSpec`."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import explode_array
from ..functions import html as H
from ..functions.text import (
    MISSING_ATTR, MISSING_COUNT, MISSING_TEXT, default_fill, price_value, stats_extract, strip_ws,
)
from ..functions.urls import url_page_number


@dataclass(frozen=True)
class Field:
    """First element with this tag / class / attribute, optionally inside another element.
    ``attr`` takes that attribute's value instead of the text."""

    name: str
    tag: str | None = None
    cls: str | None = None
    attr: str | None = None
    need_attr: str | None = None
    within: tuple[str | None, str | None] | None = None
    default: str = MISSING_TEXT

    def value(self, card: Column) -> Column:
        scope = H.find_element(card, *self.within) if self.within else card
        found = H.find_element(scope, self.tag, self.cls, self.need_attr)
        if self.attr:
            return H.attribute(found, self.attr)
        return strip_ws(H.text_content(found))


@dataclass(frozen=True)
class CardSpec:
    tag: str | None
    cls: str
    fields: tuple[Field, ...]


# The class names of the card layouts that are understood out of the box.
DEAL_CARD = CardSpec(None, "product-item-detail", (
    Field("product_name", "h3"),
    Field("current_price", cls="price"),
    Field("special_price", cls="spacail-price"),
    Field("discount", cls="discount"),
    Field("image_url", "img", attr="data-src", need_attr="data-src"),
))
DEAL_SEARCH_CARD = CardSpec(None, "product-item-detail", (
    *DEAL_CARD.fields,
    Field("product_url", "a", attr="href"),
))
DEAL_ATTR_CARD = CardSpec("div", "product-item-detail", (
    Field("time_posted", "div", "time", attr="title", default=MISSING_ATTR),
    Field("discount", "div", "discount", default=MISSING_ATTR),
    Field("title", "h3", attr="title", default=MISSING_ATTR),
    Field("original_price", "p", "price", default=MISSING_ATTR),
    Field("special_price", "p", "spacail-price", default=MISSING_ATTR),
    Field("shop_link", "a", attr="href", within=("div", "shop-now-button"), default=MISSING_ATTR),
))
ASSET_CARD = CardSpec(None, "ProjectCoverNeue-cover-X3S", (
    Field("title", "a", "Title-title-lpJ"),
    Field("creator", "a", "Owners-owner-EEG"),
    Field("price", "span", "PaidAssetsCountBadge-count-yPz"),
    Field("likes", "span", within=("div", "Stats-stats-Q1s"), default=MISSING_COUNT),
))
JOB_CARD = CardSpec(None, "JobCard-jobCard-mzZ", (
    Field("title", "h3", "JobCard-jobTitle-LS4"),
    Field("company", "p", "JobCard-company-GQS"),
    Field("location", "p", "JobCard-jobLocation-sjd"),
    Field("description", "p", "JobCard-jobDescription-SYp"),
    Field("posted", "span", "JobCard-time-Cvz"),
))
PROJECT_CARD = CardSpec(None, "ProjectCover-root-X6u", (
    Field("title", cls="Title-title-lpJ"),
    Field("author", cls="Owners-owner-EEG", default=MISSING_ATTR),
    Field("stats", cls="Stats-stats-Q1s"),
    Field("image_url", cls="ProjectCoverNeue-image-TFB", attr="src", default=MISSING_ATTR),
    Field("image_alt", cls="ProjectCoverNeue-image-TFB", attr="alt", default=MISSING_ATTR),
    Field("featured", cls="Feature-ribbon-Tyk"),
))


def split_cards(pages: DataFrame, spec: CardSpec, target: int | None = None) -> DataFrame:
    """One row per card with the page's other columns; ``position`` counts from 0. No shuffle.

    With a ``target`` only the first so many cards of each page are taken, before any is read."""
    cards = H.find_elements(H.strip_inert(F.col("html")), spec.tag, spec.cls)
    if target is not None:
        cards = F.slice(cards, 1, target)
    kept = [c for c in pages.columns if c != "html"]
    return explode_array(pages, kept, cards, "card")


def read_fields(cards: DataFrame, spec: CardSpec) -> DataFrame:
    """Card rows -> one column per field, NULL where the element is missing."""
    return cards.withColumns({f.name: f.value(F.col("card")) for f in spec.fields})


def extract_cards(pages: DataFrame, spec: CardSpec, target: int | None = None) -> DataFrame:
    """Cards with NULL for missing elements (so missing and present stay distinguishable)."""
    return read_fields(split_cards(pages, spec, target), spec).drop("card")


def with_defaults(cards: DataFrame, spec: CardSpec) -> DataFrame:
    """Last projection of a card query: NULL -> the field's sentinel text."""
    return cards.withColumns(
        {f.name: default_fill(F.col(f.name), f.default, strip=False) for f in spec.fields}
    )


def deal_cards(pages: DataFrame, spec: CardSpec = DEAL_CARD, target: int | None = None) -> DataFrame:
    return with_defaults(extract_cards(pages, spec, target), spec)


def deal_cards_attr(pages: DataFrame) -> DataFrame:
    return deal_cards(pages, DEAL_ATTR_CARD).withColumn(
        "page_number", url_page_number(F.col("url"))
    )


def project_cards(pages: DataFrame) -> DataFrame:
    """Nested project records; a card without a title is no record."""
    cards = split_cards(pages, PROJECT_CARD)
    link = H.closest_link(F.col("card"), PROJECT_CARD.fields[0].cls)
    flat = read_fields(cards, PROJECT_CARD).withColumn("link", link)
    text = {f.name: F.coalesce(F.col(f.name), F.lit(f.default)) for f in PROJECT_CARD.fields}
    return flat.where(F.length("title") > 0).select(
        "page_id",
        "position",
        "title",
        text["author"].alias("author"),
        stats_extract(F.coalesce("stats", F.lit(""))).alias("stats"),
        F.col("featured").isNotNull().alias("featured"),
        F.coalesce("link", F.lit("")).alias("url"),
        F.struct(text["image_url"].alias("url"), text["image_alt"].alias("alt")).alias("image"),
    )


def split_bad_cards(cards: DataFrame, spec: CardSpec, price: str) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of extracted cards: no field found at all, or a price that is no number."""
    empty = F.coalesce(*[F.col(f.name) for f in spec.fields]).isNull()
    bad_price = F.col(price).isNotNull() & price_value(F.col(price)).isNull()
    reason = F.when(empty, "no_fields").when(bad_price, "price_not_numeric")
    checked = cards.withColumn("reason", reason)
    return (
        checked.where(F.col("reason").isNull()).drop("reason"),
        checked.where(F.col("reason").isNotNull()).select(
            "page_id", "position", "reason"
        ),
    )


def take_target(cards: DataFrame, target: int) -> DataFrame:
    """The first ``target`` of every page's remaining cards (after filters), in page order.

    The window keeps ``target`` rows per page and task before it shuffles."""
    order = Window.partitionBy("page_id").orderBy("position")
    return (
        cards.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= target).drop("_n")
    )


def target_shortfall(pages: DataFrame, spec: CardSpec, target: int) -> DataFrame:
    """Per page, also one without a card: cards found, how many are missing to the target, and the
    loaded fraction. Counted in each page's row; nothing is shuffled."""
    found = F.size(H.find_elements(H.strip_inert(F.col("html")), spec.tag, spec.cls))
    return (
        pages.select("page_id", found.cast("bigint").alias("n_found"))
        .withColumn("n_taken", F.least("n_found", F.lit(target)))
        .withColumn("shortfall", F.lit(target) - F.col("n_taken"))
        .withColumn("progress", F.col("n_taken") / F.lit(float(target)))
    )
