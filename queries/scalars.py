"""Scalar projections and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesmith.functions import text as X
from pagesmith.functions import urls as U
from pagesmith.functions.html import page_title

from .common import table


def validate_url(spark, sf):
    url = F.col("url")
    forms = F.array(
        url, F.lit(""), F.regexp_replace(url, "^https?", "ftp"), F.regexp_replace(url, "^https?://", ""),
        F.replace(url, F.lit(".example."), F.lit(" ")),
    )
    rows = table(spark, sf, "pages").select("page_id", F.posexplode(forms).alias("form", "url"))
    check = U.validate_url(F.col("url"))
    return rows.select("page_id", "form", check["ok"].cast("int").alias("ok"), check["reason"].alias("reason"))


def url_slug(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.url_slug(F.col("url")).alias("slug"))


def url_page_number(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", U.url_page_number(F.col("url")).alias("page"), U.url_page_int(F.col("url")).alias("page_int")
    )


def name_slug(spark, sf):
    name = F.concat_ws(" ", "p_name", "p_brand")
    return table(spark, sf, "part").select(
        "p_partkey", X.name_slug(name).alias("url_slug"), X.name_slug(name, "_").alias("file_slug")
    )


def strip_urls(spark, sf):
    """Documents as they are, and pages' URLs inside markdown links and running text."""
    docs = table(spark, sf, "documents").select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), "text")
    linked = F.concat(F.lit("see [x]("), "url", F.lit(") and "), "url", F.lit(", end é"))
    pages = table(spark, sf, "pages").select(F.lit("p").alias("kind"), F.col("page_id").alias("id"), linked.alias("text"))
    return docs.union(pages).select("kind", "id", F.md5(X.strip_urls(F.col("text"))).alias("text_md5"))


def clean_price(spark, sf):
    shown = F.when(F.col("p_type") != "ECONOMY", F.concat(F.lit(" ₹ "), F.format_number("p_retailprice", 2), F.lit(" ")))
    return table(spark, sf, "part").select(
        "p_partkey", X.default_fill(X.clean_price(shown)).alias("price"),
        X.price_value(shown).cast("double").alias("price_value"),
    )


def default_fill(spark, sf):
    padded = F.concat(F.lit("\t \xa0"), F.col("p_name"), F.lit(" \n"))
    some = F.when(F.col("p_size") > 20, padded)
    return table(spark, sf, "part").select(
        "p_partkey", X.default_fill(some).alias("text"), X.default_fill(some, X.MISSING_ATTR).alias("attr"),
        X.default_fill(some, X.MISSING_COUNT).alias("n"), X.default_fill(some, strip=False).alias("raw"),
    )


def stats_extract(spark, sf):
    shown = F.when(F.col("s_acctbal") > 0, F.concat("s_nationkey", F.lit("K likes, "), F.col("s_acctbal").cast("decimal(12,2)"), F.lit("M"))).otherwise(F.lit("new"))
    stats = X.stats_extract(shown)
    return table(spark, sf, "supplier").select(
        "s_suppkey", stats["appreciations"].alias("appreciations"), stats["views"].alias("views")
    )


def keyword_filter(spark, sf):
    return table(spark, sf, "part").where(X.keyword_match(F.col("p_name"), "RING")).select("p_partkey", "p_name")


def text_preview(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", X.preview(F.col("text")).alias("preview"), X.preview(F.col("text"), 200).alias("debug_preview")
    )


def column_labels(spark, sf):
    key = F.lower(F.concat_ws("_", "o_orderpriority", "o_orderstatus"))
    return table(spark, sf, "orders").select("o_orderkey", X.column_label(key).alias("label"))


def threshold_label(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.col("value").alias("score"), X.threshold_label(F.col("value")).alias("res")
    )


def presence_flag(spark, sf):
    marker = F.col("html").rlike(r'(?i)class="ad"')
    return table(spark, sf, "pages").select("page_id", marker.cast("int").alias("has_ad"))


def require_title(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", page_title(F.col("html")).alias("title"))
    return pages.where(F.length("title") > 0)


QUERIES = {
    f.__name__: f
    for f in (
        validate_url, url_slug, url_page_number, name_slug, strip_urls, clean_price, default_fill,
        stats_extract, keyword_filter, text_preview, column_labels, threshold_label, presence_flag,
        require_title,
    )
}

ORACLE = {
    "validate_url": r"""
WITH f AS (SELECT page_id, unnest([url, '', regexp_replace(url, '^https?', 'ftp'), regexp_replace(url, '^https?://', ''),
                  replace(url, '.example.', ' ')]) AS url, unnest(range(5)) AS form FROM pages),
r AS (SELECT page_id, form, CASE WHEN url = '' THEN 'empty'
        WHEN NOT regexp_matches(url, '^(https?|ftp)://([A-Za-z0-9-]+\.)+[a-z]+([/?#][^\s]*)?$') THEN 'bad_format'
        WHEN NOT (starts_with(url, 'http://') OR starts_with(url, 'https://')) THEN 'bad_scheme' ELSE '' END AS reason FROM f)
SELECT page_id, form, CASE WHEN reason = '' THEN 1 ELSE 0 END AS ok, reason FROM r""",
    "url_slug": "SELECT page_id, list_extract(string_split(url, '/'), -1) AS slug FROM pages",
    "url_page_number": r"""
SELECT page_id, string_split(list_extract(string_split(url, 'page='), -1), '&')[1] AS page,
       TRY_CAST(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS INTEGER) AS page_int FROM pages""",
    "name_slug": """
SELECT p_partkey, replace(lower(p_name || ' ' || p_brand), ' ', '-') AS url_slug,
       replace(lower(p_name || ' ' || p_brand), ' ', '_') AS file_slug FROM part""",
    "strip_urls": r"""
WITH t AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL
           SELECT 'p', page_id, 'see [x](' || url || ') and ' || url || ', end é' FROM pages)
SELECT kind, id, md5(regexp_replace(text, 'https?://[!$-_a-z]+', '', 'g')) AS text_md5 FROM t""",
    "clean_price": """
SELECT p_partkey, CASE WHEN p_type <> 'ECONOMY' THEN format('{:.2f}', p_retailprice) ELSE 'N/A' END AS price,
       CASE WHEN p_type <> 'ECONOMY' THEN round(p_retailprice, 2) END AS price_value FROM part""",
    "default_fill": """
SELECT p_partkey, CASE WHEN p_size > 20 THEN p_name ELSE 'N/A' END AS text, CASE WHEN p_size > 20 THEN p_name ELSE '' END AS attr,
       CASE WHEN p_size > 20 THEN p_name ELSE '0' END AS n,
       CASE WHEN p_size > 20 THEN chr(9) || ' ' || chr(160) || p_name || ' ' || chr(10) ELSE 'N/A' END AS raw FROM part""",
    "stats_extract": r"""
WITH s AS (SELECT s_suppkey, regexp_extract_all(CASE WHEN s_acctbal > 0 THEN s_nationkey || 'K likes, ' ||
             CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR) || 'M' ELSE 'new' END, '[0-9]+[KMB]?') AS a FROM supplier)
SELECT s_suppkey, coalesce(a[1], '0') AS appreciations, coalesce(a[2], '0') AS views FROM s""",
    "keyword_filter": "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring')",
    "text_preview": "SELECT doc_id, substr(text, 1, 1000) || '...' AS preview, substr(text, 1, 200) || '...' AS debug_preview FROM documents",
    "column_labels": r"""
SELECT o_orderkey, array_to_string(list_transform(regexp_extract_all(replace(lower(o_orderpriority || '_' || o_orderstatus), '_', ' '),
       '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), '') AS label FROM orders""",
    "threshold_label": "SELECT event_id, value AS score, CASE WHEN value >= 50 THEN 'PASS' ELSE 'FAIL' END AS res FROM events",
    "presence_flag": "SELECT page_id, CASE WHEN contains(html, 'class=\"ad\"') THEN 1 ELSE 0 END AS has_ad FROM pages",
    "require_title": r"""
SELECT page_id, replace(replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '&quot;', '"'), '&amp;', '&') AS title FROM pages
WHERE length(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)) > 0""",
}
