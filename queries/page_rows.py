"""Cleaned pages, markdown, links, titles and tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesmith.cluster import spread
from pagesmith.functions import html as H
from pagesmith.operators import page_rows as P

from .common import BASE, _INERT, dealt, escaped, quote, rx, sql_clean, sql_decode, sql_markdown, sql_text, table
from .scans import NAV_PATH


def _pages(spark, sf):
    return spread(table(spark, sf, "pages"))


def clean_html(spark, sf):
    cleaned = H.clean_html(F.col("html"))
    return _pages(spark, sf).select("page_id", F.md5(cleaned).alias("html_md5"))


def html_to_markdown(spark, sf):
    return _pages(spark, sf).select("page_id", H.to_markdown(F.col("html")).alias("markdown"))


def extract_links(spark, sf):
    return P.page_links(_pages(spark, sf)).select("page_id", "position", "href")


def page_title(spark, sf):
    return _pages(spark, sf).select("page_id", H.page_title(F.col("html")).alias("title"))


def container_links(spark, sf):
    return P.container_links(_pages(spark, sf), NAV_PATH).drop("url")


def sorted_names(spark, sf):
    return P.sorted_names(P.container_links(_pages(spark, sf), NAV_PATH))


def select_classes(spark, sf):
    return _pages(spark, sf).select("page_id", P.class_text(F.col("html"), ["ad"]).alias("text"))


def page_text(spark, sf):
    return P.page_text_preview(_pages(spark, sf)).drop("url")


# One table page per block of 25 customers. Some rows lack a cell, some have none; a page whose
# block starts with a MACHINERY customer holds a table with another id.
PER_TABLE = 25


def table_pages(spark, sf):
    name = escaped(F.concat("c_name", F.lit(" & Co <x>")))
    cells = F.concat(
        F.lit("<td>"), "c_custkey", F.lit("</td><td class='n'> "), name, F.lit(" </td>"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.concat(F.lit("<td>"), "c_mktsegment", F.lit("</td>"))),
    )
    row = F.concat(F.lit("<tr>"), F.when(F.col("c_acctbal") > 9500, "").otherwise(cells), F.lit("</tr>"))
    blocks = table(spark, sf, "customer").withColumn("page_id", F.floor(F.col("c_custkey") / PER_TABLE))
    rows = F.array_sort(F.collect_list(F.struct(F.col("c_custkey").alias("k"), row.alias("r"))))
    grouped = dealt(blocks, "page_id").groupBy("page_id").agg(
        rows.alias("rows"), F.min_by("c_mktsegment", "c_custkey").alias("first")
    )
    html = F.concat(
        F.lit('<html><body><table id="menu"><tr><td>0</td></tr></table><table class="t" id="'),
        F.when(F.col("first") == "MACHINERY", "other").otherwise("libraries"),
        F.lit('"><thead><tr><th> id </th><th>name</th><th>segment</th></tr></thead><tbody>'),
        F.array_join(F.transform("rows", lambda r: r["r"]), "\n"),
        F.lit("</tbody></table><table><tr><td>9</td></tr></table></body></html>"),
    )
    url = F.concat(F.lit(f"{BASE}/libraries/"), "page_id")
    return grouped.select("page_id", url.alias("url"), html.alias("html"))


def html_table_rows(spark, sf):
    good, _, _ = P.table_rows(table_pages(spark, sf), "libraries")
    return P.widen(good, ["id", "name", "segment"])


def html_table_rejects(spark, sf):
    _, bad, missing = P.table_rows(table_pages(spark, sf), "libraries")
    no_table = missing.select("page_id", F.lit(0).alias("row_idx"), F.lit("no_table").alias("reason"))
    return bad.select("page_id", "row_idx", F.col("cells_of_headers").alias("reason")).union(no_table)


QUERIES = {
    f.__name__: f
    for f in (
        clean_html, html_to_markdown, extract_links, page_title, container_links, sorted_names,
        select_classes, page_text, html_table_rows, html_table_rejects,
    )
}

_NO_INERT = rx("html", [(_INERT, "")])
_NAV = r"regexp_extract(html, '(?is)<nav\b[^>]*>(.*?)</nav>', 1)"
_LINK = quote(r'<a href="([^"]*)">([^<]*)</a>')
_TABLES = f"""t AS (
  SELECT c_custkey // {PER_TABLE} AS page_id,
         row_number() OVER (PARTITION BY c_custkey // {PER_TABLE} ORDER BY c_custkey) AS row_idx,
         first_value(c_mktsegment) OVER (PARTITION BY c_custkey // {PER_TABLE} ORDER BY c_custkey) AS first,
         c_custkey, c_name, c_mktsegment, c_acctbal FROM customer)"""
ORACLE = {
    "clean_html": f"SELECT page_id, md5({sql_clean('html')}) AS html_md5 FROM pages",
    "html_to_markdown": f"SELECT page_id, {sql_markdown('html')} AS markdown FROM pages",
    "extract_links": f"""
WITH l AS (SELECT page_id, regexp_extract_all({_NO_INERT}, {_LINK}, 1) AS a FROM pages)
SELECT page_id, unnest(a) AS href, unnest(range(len(a))) AS position FROM l""",
    "page_title": f"""
SELECT page_id, {sql_decode("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")} AS title FROM pages""",
    "container_links": f"""
WITH l AS (SELECT page_id, regexp_extract_all({_NAV}, {_LINK}, 1) AS a, regexp_extract_all({_NAV}, {_LINK}, 2) AS b FROM pages)
SELECT page_id, unnest(a) AS href, unnest(b) AS name, unnest(range(len(a))) AS position FROM l""",
    "sorted_names": f"""
SELECT name FROM (SELECT trim(unnest(regexp_extract_all({_NAV}, {_LINK}, 2))) AS name FROM pages) WHERE name <> ''""",
    "select_classes": f"""
SELECT page_id, {sql_decode("array_to_string(regexp_extract_all(html, '(?is)<div class=\"ad\">(.*?)</div>', 1), '')")} AS text FROM pages""",
    "page_text": f"SELECT page_id, substr({sql_text('html')}, 1, 1000) || '...' AS preview FROM pages",
    "html_table_rows": f"""
WITH {_TABLES}
SELECT page_id, row_idx, CAST(c_custkey AS VARCHAR) AS id, c_name || ' & Co <x>' AS name, c_mktsegment AS segment
FROM t WHERE first <> 'MACHINERY' AND c_acctbal >= 0 AND c_acctbal <= 9500""",
    "html_table_rejects": f"""
WITH {_TABLES}
SELECT page_id, row_idx, '2/3' AS reason FROM t WHERE first <> 'MACHINERY' AND c_acctbal < 0
UNION ALL SELECT DISTINCT page_id, 0, 'no_table' FROM t WHERE first = 'MACHINERY'""",
}
