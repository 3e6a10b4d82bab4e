"""Rows read off a page: links, tables, pagers, selected classes, titles and text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..cluster import explode_array
from ..functions import html as H
from ..functions.text import preview, strip_ws


def page_links(pages: DataFrame) -> DataFrame:
    """Every link with a non-empty href, duplicates kept, ``position`` in page order."""
    rows = explode_array(pages, ["page_id", "url"], H.links(F.col("html")), "l")
    return rows.select(
        "page_id", "url", "position", F.col("l.name").alias("name"), F.col("l.url").alias("href")
    )


def _descend(html: Column, path: Sequence[tuple[str | None, str | None]]) -> Column:
    found = F.array(H.strip_inert(html))
    for tag, cls in path:
        found = F.flatten(F.transform(found, _finder(tag, cls)))
    return found


def _finder(tag: str | None, cls: str | None):
    return lambda element: H.find_elements(element, tag, cls)


def container_links(pages: DataFrame, path: Sequence[tuple[str | None, str | None]]) -> DataFrame:
    """Name and href of the links below nested containers, e.g. ``nav > ul > li``."""
    found = F.flatten(F.transform(_descend(F.col("html"), path), H.links))
    rows = explode_array(pages, ["page_id", "url"], found, "l")
    return rows.select(
        "page_id", "url", "position", F.col("l.name").alias("name"), F.col("l.url").alias("href")
    )


def sorted_names(rows: DataFrame, name: str = "name") -> DataFrame:
    """Non-empty names ascending by code point, duplicates kept (a range-partitioned sort)."""
    return rows.select(strip_ws(F.col(name)).alias(name)).where(F.length(name) > 0).orderBy(name)


def pagination_count(html: Column, cls: str = "pagination") -> Column:
    """Number shown in the pager's second-last item; 1 without a pager of at least two items;
    NULL when that item is no number."""
    pager = F.coalesce(H.find_element(html, "ul", cls), F.lit(""))

    items = F.transform(H.find_elements(pager, "li"), lambda li: strip_ws(H.text_content(li)))
    last_page = "CASE WHEN size({0}) > 1 THEN try_cast(get({0}, size({0}) - 2) AS INT) ELSE 1 END"
    return H.bind(items, last_page.format)


def class_text(html: Column, classes: Sequence[str], joiner: str = "") -> Column:
    """Text of the elements that carry one of the classes, class by class in page order."""
    bodies = F.flatten(F.array(*[H.find_elements(H.strip_inert(html), None, c) for c in classes]))
    return F.array_join(F.transform(bodies, H.text_content), joiner)


def table_rows(pages: DataFrame, element_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, rejects, pages without the table) of the table with an element id.

    A row's ``cells`` are (header, cell) pairs in page order, as headers may be empty or repeat.

    The header is the text of all ``th`` cells, rows are the ``tr`` elements after the first, empty
    rows are dropped, and a row whose cell count differs from the header's is a reject."""
    texts = lambda cells: F.transform(cells, lambda c: strip_ws(H.text_content(c)))
    found = pages.select(
        "page_id",
        "url",
        H.find_element(H.strip_inert(F.col("html")), "table", element_id=element_id).alias("tab"),
    )
    missing = found.where(F.col("tab").isNull()).select("page_id", "url")
    headers = texts(H.find_elements(F.col("tab"), "th")).alias("headers")
    found_rows = explode_array(
        found, ["page_id", headers], H.find_elements(F.col("tab"), "tr"), "tr", "row_idx"
    )
    rows = (
        found_rows.where(F.col("row_idx") > 0)
        .select(
            "page_id", "headers", "row_idx",
            texts(H.find_elements(F.col("tr"), "td")).alias("cells"),
        )
        .where(F.size("cells") > 0)
    )
    fits = F.size("cells") == F.size("headers")
    cell = F.zip_with("headers", "cells", lambda h, c: F.struct(h.alias("header"), c.alias("cell")))
    good = rows.where(fits).select("page_id", "row_idx", cell.alias("cells"))
    bad = rows.where(~fits).select(
        "page_id", "row_idx",
        F.concat_ws("/", F.size("cells"), F.size("headers")).alias("cells_of_headers"),
    )
    return good, bad, missing


def widen(rows: DataFrame, headers: Sequence[str]) -> DataFrame:
    """Long table rows -> one column per declared header (the first of that name; headers may repeat).
    A projection; nothing is shuffled."""
    named = lambda h: F.filter("cells", lambda c: c["header"] == h)
    cell = lambda h: F.get(named(h), F.lit(0))["cell"].alias(h)
    return rows.select("page_id", "row_idx", *[cell(h) for h in headers])


def page_text_preview(pages: DataFrame, chars: int = 1000) -> DataFrame:
    return pages.select("page_id", "url", preview(H.to_text(F.col("html")), chars).alias("preview"))
