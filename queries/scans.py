"""Scans and frontiers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pagesmith.cluster import shared_folder, spread
from pagesmith.operators.page_rows import container_links
from pagesmith.operators.pricing import pricing_table
from pagesmith.operators.runs import write_texts
from pagesmith.sources import frontier, pages as source

from .common import BASE, PRICING_SQL, second_text, shop_url, table

NAV_PATH = (("nav", None), ("ul", None), ("li", None))


def pages_scan(spark, sf):
    pages = source.scan_pages(spark, f"{sf}/pages.parquet")
    status = F.when(F.contains("html", F.lit("</html>")), 200).otherwise(502)
    good, bad = source.split_by_status(pages.withColumn("status", status))
    cols = ["page_id", "url", F.length("html").alias("n_chars")]
    return good.select(*cols, F.lit("").alias("reason")).union(bad.select(*cols, "reason"))


def html_dir_scan(spark, sf):
    folder = f"{shared_folder(spark)}/saved-pages-{uuid.uuid4().hex}"
    write_texts(spread(table(spark, sf, "pages")).select(F.col("html").alias("text")), folder)
    files = source.scan_html_dir(spark, folder, "*.txt")
    return files.select(F.md5("html").alias("html_md5"), F.length("html").alias("n_chars"))


def text_scan(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5")
    )


def page_url_frontier(spark, sf):
    word = F.concat(F.lit("50% off/"), F.col("s_name"), F.lit(" é~*"))
    stores = table(spark, sf, "supplier").select(
        F.col("s_name").alias("store"),
        (1 + F.col("s_nationkey") % 10).alias("n_pages"),
        F.when(F.col("s_acctbal") > 0, word).otherwise("").alias("keyword"),
    )
    both = [
        frontier.store_page_urls(stores, BASE, encoded).withColumn("encoded", F.lit(int(encoded)))
        for encoded in (False, True)
    ]
    return both[0].union(both[1]).select("store", "page_number", "encoded", "url")


def search_url_frontier(spark, sf):
    searches = table(spark, sf, "part").select(
        F.col("p_brand").alias("store"), F.concat_ws(" ", "p_name", "p_type").alias("keyword")
    )
    return frontier.search_urls(searches, BASE)


def pages_to_fetch(spark, sf):
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        frontier.pages_to_fetch(F.lit(10), F.col("s_nationkey") + 1).alias("pages_to_fetch"),
    )


def frontier_refresh(spark, sf):
    urls = table(spark, sf, "customer").select(
        F.concat(F.lit("https://shop"), F.col("c_custkey"), F.lit(".example.com/")).alias("url")
    )
    fetches = table(spark, sf, "events").select(shop_url().alias("url"), F.col("ts").alias("fetched_at"))
    marked = frontier.mark_fresh(urls, fetches, "2024-01-15 12:00:00")
    return marked.select("url", second_text(F.col("last_fetch")).alias("last_fetch"), "action")


def link_frontier(spark, sf):
    return frontier.link_frontier(container_links(spread(table(spark, sf, "pages")), NAV_PATH))


def extraction_requests(spark, sf):
    fields = F.when(F.startswith("url", F.lit("http://")), F.array().cast("array<string>")).otherwise(
        F.array(F.lit("title"), F.lit("href"))
    )
    model = F.when(F.contains("url", F.lit("?")), F.lit(None)).when(
        F.contains("url", F.lit("#")), F.lit("no-such-model")
    ).otherwise(F.lit("gpt-4o-mini"))
    requests = table(spark, sf, "pages").select("url", fields.alias("fields"), model.cast("string").alias("model"))
    good, bad = frontier.check_requests(requests, pricing_table(spark))
    cols = ["url", F.size("fields").alias("n_fields"), "model"]
    return good.select(*cols, F.lit("").alias("reason")).union(bad.select(*cols, "reason"))


QUERIES = {
    f.__name__: f
    for f in (
        pages_scan, html_dir_scan, text_scan, page_url_frontier, search_url_frontier,
        pages_to_fetch, frontier_refresh, link_frontier, extraction_requests,
    )
}

_ENC = "replace(url_encode({}), '%2F', '/')"
ORACLE = {
    "pages_scan": """
SELECT page_id, url, length(html) AS n_chars,
       CASE WHEN contains(html, '</html>') THEN '' ELSE 'http_502' END AS reason FROM pages""",
    "html_dir_scan": """
SELECT md5(html || chr(10)) AS html_md5, length(html) + 1 AS n_chars FROM pages""",
    "text_scan": "SELECT doc_id, length(text) AS n_chars, md5(text) AS text_md5 FROM documents",
    "page_url_frontier": f"""
WITH s AS (SELECT s_name, 1 + s_nationkey % 10 AS n,
                  CASE WHEN s_acctbal > 0 THEN '50% off/' || s_name || ' é~*' ELSE '' END AS kw FROM supplier),
p AS (SELECT s.*, unnest(range(1, n + 1)) AS page_number FROM s),
e AS (SELECT p.*, unnest([0, 1]) AS encoded FROM p)
SELECT s_name AS store, page_number, encoded,
       '{BASE}/store/' || lower(s_name) || '?page=' || page_number ||
       CASE WHEN kw = '' THEN '' WHEN encoded = 1 THEN '&keyword=' || {_ENC.format('kw')}
            ELSE '&keyword=' || kw END AS url FROM e""",
    "search_url_frontier": f"""
WITH s AS (SELECT p_brand AS store, p_name || ' ' || p_type AS keyword FROM part)
SELECT store, keyword, '{BASE}/store/' || store || '?keyword=' || {_ENC.format('keyword')} AS store_url,
       '{BASE}/search?keyword=' || {_ENC.format('keyword')} || '&store=' || store AS fallback_url FROM s""",
    "pages_to_fetch": "SELECT s_suppkey, least(10, s_nationkey + 1) AS pages_to_fetch FROM supplier",
    "frontier_refresh": """
WITH last AS (SELECT 'https://shop' || user_id || '.example.com/' AS url, max(ts) AS t FROM events
              WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1)
SELECT f.url, strftime(t, '%Y-%m-%d %H:%M:%S') AS last_fetch,
       CASE WHEN TIMESTAMP '2024-01-15 12:00:00' - t < INTERVAL 3600 SECOND THEN 'reuse' ELSE 'refetch' END AS action
FROM (SELECT 'https://shop' || c_custkey || '.example.com/' AS url FROM customer) f LEFT JOIN last USING (url)""",
    "link_frontier": r"""
WITH n AS (SELECT url, regexp_extract(html, '(?is)<nav\b[^>]*>(.*?)</nav>', 1) AS nav FROM pages),
l AS (SELECT url, unnest(regexp_extract_all(nav, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href,
             unnest(regexp_extract_all(nav, '<a href="([^"]*)">([^<]*)</a>', 2)) AS name,
             unnest(range(len(regexp_extract_all(nav, '<a href="([^"]*)">([^<]*)</a>')))) AS position FROM n)
SELECT url AS found_on, position, name, regexp_extract(url, '^[a-z]+://[^/?#]*') || href AS url FROM l""",
    "extraction_requests": f"""
WITH r AS (SELECT url, CASE WHEN starts_with(url, 'http://') THEN 0 ELSE 2 END AS n_fields,
             CASE WHEN contains(url, '?') THEN 'gemini-1.5-flash' WHEN contains(url, '#') THEN 'no-such-model'
                  ELSE 'gpt-4o-mini' END AS model FROM pages)
SELECT url, n_fields, r.model, CASE WHEN n_fields = 0 THEN 'no_fields'
       WHEN pr.model IS NULL THEN 'unsupported_model' ELSE '' END AS reason
FROM r LEFT JOIN {PRICING_SQL} ON r.model = pr.model""",
}
