"""Card layouts, pagers, harvest statistics and the joins that complete card records.

Pages are made from rows of the given tables and read back, so the SQL side is the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesmith.operators import cards as C
from pagesmith.operators import enrich as E
from pagesmith.operators.page_rows import pagination_count as last_page
from pagesmith.plans.harvest import harvest_store_deals

from .common import (
    BASE, DEALS_SQL, _or_nothing, deal_card, dealt, deal_pages, deal_rows, escaped, pages_of_cards, sql_text, table,
)


def deal_cards(spark, sf):
    return C.deal_cards(deal_pages(spark, sf)).drop("url")


def deal_cards_search(spark, sf):
    return C.deal_cards(deal_pages(spark, sf), C.DEAL_SEARCH_CARD).drop("url")


def bad_rows(spark, sf):
    cards = C.extract_cards(deal_pages(spark, sf), C.DEAL_CARD)
    return C.split_bad_cards(cards, C.DEAL_CARD, "current_price")[1]


def attr_deal_pages(spark, sf):
    c, lit = F.col, F.lit
    rows = table(spark, sf, "part").withColumn("title", escaped(F.concat("p_name", lit(' & "'), "p_type", lit('"'))))
    card = F.concat(
        lit('<div class="product-item-detail"><div class="time" title="'), c("p_size"), lit(' hours ago"></div>'),
        _or_nothing(lit('<div class="discount">'), F.when(c("p_size") >= 10, c("p_size")), lit("%</div>")),
        lit('<a href="/all"><h3 title="'), F.replace(c("title"), lit('"'), lit("&quot;")), lit('">short...</h3></a>'),
        lit('<p class="price">'), F.format_number("p_retailprice", 2), lit("</p>"),
        _or_nothing(lit('<p class="spacail-price">'), F.when(c("p_type") != "ECONOMY", c("p_brand")), lit("</p>")),
        lit('<div class="x shop-now-button"><a class="b" href="/go?id='), c("p_partkey"), lit('&amp;r=1">Shop</a></div></div>'),
    )
    url = F.concat(lit(f"{BASE}/store/s?page="), c("page_id"), lit("&keyword=y"))
    return pages_of_cards(rows, "p_partkey", card, url)


def deal_cards_attr(spark, sf):
    return C.deal_cards_attr(attr_deal_pages(spark, sf)).drop("url")


def asset_cards(spark, sf):
    c, lit = F.col, F.lit
    card = F.concat(
        lit('<div class="ProjectCoverNeue-cover-X3S"><a class="Title-title-lpJ" href="#">'), c("p_name"), lit("</a>"),
        _or_nothing(lit('<a class="Owners-owner-EEG">'), F.when(c("p_size") > 5, c("p_brand")), lit("</a>")),
        _or_nothing(lit('<span class="PaidAssetsCountBadge-count-yPz">'), F.when(c("p_type") != "ECONOMY", c("p_retailprice").cast("decimal(12,2)")), lit("</span>")),
        _or_nothing(lit('<div class="Stats-stats-Q1s"><i></i><span>'), F.when(c("p_size") > 10, c("p_size")), lit("</span><span>9</span></div>")),
        lit("</div>"),
    )
    pages = pages_of_cards(table(spark, sf, "part"), "p_partkey", card, F.concat(lit(f"{BASE}/assets/"), "page_id"))
    return C.deal_cards(pages, C.ASSET_CARD).drop("url")


def job_cards(spark, sf):
    c, lit = F.col, F.lit
    card = F.concat(
        lit('<li class="JobCard-jobCard-mzZ"><h3 class="JobCard-jobTitle-LS4">Clerk '), c("c_custkey"), lit("</h3>"),
        lit('<p class="JobCard-company-GQS">'), c("c_name"), lit("</p>"),
        _or_nothing(lit('<p class="JobCard-jobLocation-sjd">Nation '), F.when(c("c_acctbal") > 0, c("c_nationkey")), lit("</p>")),
        lit('<p class="JobCard-jobDescription-SYp">Sells <b>'), c("c_mktsegment"), lit("</b> &amp; more</p>"),
        _or_nothing(lit('<span class="JobCard-time-Cvz">'), F.when(c("c_acctbal") > 5000, c("c_nationkey")), lit(" days ago</span>")),
        lit("</li>"),
    )
    pages = pages_of_cards(table(spark, sf, "customer"), "c_custkey", card, F.concat(lit(f"{BASE}/jobs/"), "page_id"))
    return C.deal_cards(pages, C.JOB_CARD).drop("url")


def project_pages(spark, sf):
    """One project per supplier; it links to the stored page with the supplier's number."""
    c, lit = F.col, F.lit
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("s_suppkey"), F.col("url").alias("target"))
    rows = table(spark, sf, "supplier").join(pages, "s_suppkey", "left")
    title = F.concat(lit('<span class="Title-title-lpJ">'), c("s_name"), lit("</span>"))
    card = F.concat(
        lit('<div class="ProjectCover-root-X6u"><a href="/other">x</a>'),
        F.when(c("target").isNotNull(), F.concat(lit('<a href="'), escaped(c("target")), lit('">'), title, lit("</a>")))
        .otherwise(F.when(c("s_nationkey") > 3, title).otherwise("")),
        _or_nothing(lit('<a class="Owners-owner-EEG"> N'), F.when(c("s_nationkey") > 5, c("s_nationkey")), lit(" </a>")),
        _or_nothing(lit('<div class="Stats-stats-Q1s"><i>'), F.when(c("s_acctbal") > 0, c("s_suppkey")), lit(" likes</i> "), c("s_nationkey"), lit("K views</div>")),
        lit('<img class="ProjectCoverNeue-image-TFB" src="/i/'), c("s_suppkey"), lit('.png" alt="pic">'),
        F.when(c("s_acctbal") > 4000, lit('<b class="Feature-ribbon-Tyk"></b>')).otherwise(""), lit("</div>"),
    )
    return pages_of_cards(rows, "s_suppkey", card, F.concat(lit(f"{BASE}/projects/"), "page_id"))


def _flat_projects(projects):
    return projects.select(
        "page_id", "position", "title", "author", "stats.appreciations", "stats.views",
        F.col("featured").cast("int").alias("featured"), "url", F.col("image.url").alias("image_url"),
        F.col("image.alt").alias("image_alt"),
    )


def project_cards(spark, sf):
    return _flat_projects(C.project_cards(project_pages(spark, sf)))


def enrich_featured(spark, sf):
    projects = C.project_cards(project_pages(spark, sf))
    done = E.enrich_featured(projects, table(spark, sf, "pages"))
    return done.select("page_id", "position", "title", "url", "detailed_content")


def sample_head(spark, sf):
    projects = _flat_projects(C.project_cards(project_pages(spark, sf)))
    return E.sample_head(projects, ["page_id", "position"]).select("number", "title", "author", "url")


def pagination_count(spark, sf):
    """Pagers of ``nation`` many entries per supplier; number 0 has no pager, 24 has a broken one."""
    n = F.col("s_nationkey")
    items = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("<li><a>"), i, F.lit("</a></li>")))
    body = F.when(n == 24, "<li>last</li>").otherwise(F.array_join(items, ""))
    pager = F.when(n > 0, F.concat(F.lit('<ul class="x pagination"><li>«</li>'), body, F.lit("<li>»</li></ul>")))
    html = F.concat(F.lit("<ul><li>7</li><li>8</li></ul>"), F.coalesce(pager, F.lit("")), F.lit("<li>5</li>"))
    return table(spark, sf, "supplier").select("s_suppkey", last_page(html).alias("n_pages"))


def take_target(spark, sf):
    return C.deal_cards(deal_pages(spark, sf), target=7).select("page_id", "position", "product_name")


def take_target_filtered(spark, sf):
    """Target applied after a filter, where positions have gaps."""
    cards = C.deal_cards(deal_pages(spark, sf)).where(F.col("discount") != "N/A")
    return C.take_target(cards, 7).select("page_id", "position", "product_name")


def target_shortfall(spark, sf):
    """Every fifth page comes again under another id, with no card on it."""
    pages = deal_pages(spark, sf).select("page_id", "html")
    bare = pages.where("page_id % 5 = 0").select(F.col("page_id") + 1_000_000, F.lit("<p>none</p>").alias("html"))
    return C.target_shortfall(pages.union(bare), C.DEAL_CARD, 25)


SEARCH_WORD = "RING"


def _search_pages(spark, sf, known_only: bool):
    """Pages of a brand's parts; in-store pages exist with cards only for brands up to 12."""
    known = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int") <= 12
    rows = deal_rows(spark, sf)
    rows = rows.where(known) if known_only else rows
    rows = dealt(rows.withColumn("block", F.floor(F.col("p_partkey") / 500)), "p_brand", "block")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", deal_card().alias("c")))), lambda r: r["c"]), "")
    pages = rows.groupBy("p_brand", "block").agg(body.alias("html")).withColumnRenamed("p_brand", "store")
    return pages.select(
        F.xxhash64("store", "block").alias("page_id"), "store", F.lit(SEARCH_WORD).alias("keyword"),
        F.concat(F.lit(f"{BASE}/search?store="), "store").alias("url"), "html",
    )


def search_fallback(spark, sf):
    pages = [_search_pages(spark, sf, known) for known in (True, False)]
    searches = table(spark, sf, "part").select(F.col("p_brand").alias("store"), F.lit(SEARCH_WORD).alias("keyword"))
    found = E.search_with_fallback(searches, *pages)
    return found.select("store", "origin", "product_name", "current_price", "product_url")


def store_lookup(spark, sf):
    stores = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("name"), F.concat(F.lit(f"{BASE}/store/order-"), "o_orderkey").alias("url"),
        F.col("o_orderkey").alias("position"),
    )
    wanted = F.create_map(*[F.lit(x) for x in ("click", "1-URGENT", "view", "2-HIGH", "signup", "3-MEDIUM", "purchase", "5-LOW")])
    selections = table(spark, sf, "events").select(
        "event_id", F.coalesce(F.try_element_at(wanted, F.col("event_type")), F.lit("unknown")).alias("name")
    )
    return E.store_lookup(selections, stores)


def _harvest(spark, sf):
    """Frontier of one store per brand-like page set, joined to the attribute-form deal pages."""
    pages = attr_deal_pages(spark, sf).withColumn("url", F.concat(F.lit(f"{BASE}/store/s"), F.floor(F.col("page_id") / 10), F.lit("?page="), 1 + F.col("page_id") % 10))
    stores = pages.select(F.concat(F.lit("S"), F.floor(F.col("page_id") / 10)).alias("store")).distinct()
    return harvest_store_deals(stores.withColumn("n_pages", F.lit(11)), pages, BASE)


def harvest_deals(spark, sf):
    return _harvest(spark, sf)[0].select("url", "page_number", "position", "title", "shop_link")


def harvest_rejects(spark, sf):
    return _harvest(spark, sf)[1]


QUERIES = {
    f.__name__: f
    for f in (
        deal_cards, deal_cards_search, bad_rows, deal_cards_attr, asset_cards, job_cards, project_cards,
        enrich_featured, sample_head, pagination_count, take_target, take_target_filtered, target_shortfall, search_fallback,
        store_lookup, harvest_deals, harvest_rejects,
    )
}

_POS = "{k} // 20 AS page_id, row_number() OVER (PARTITION BY {k} // 20 ORDER BY {k}) - 1 AS position"
_PART_POS, _CUST_POS, _SUPP_POS = (_POS.format(k=k) for k in ("p_partkey", "c_custkey", "s_suppkey"))
_DEAL_FIELDS = """coalesce(product_name, 'N/A') AS product_name, coalesce(current_price, 'N/A') AS current_price,
       coalesce(special_price, 'N/A') AS special_price, coalesce(discount, 'N/A') AS discount,
       coalesce(image_url, 'N/A') AS image_url"""
# Cards without a title still take up a position on their page.
_PROJECTS = f"""projects AS (
  SELECT * FROM (
    SELECT {_SUPP_POS}, CASE WHEN pages.url IS NOT NULL OR s_nationkey > 3 THEN s_name END AS title,
           CASE WHEN s_nationkey > 5 THEN 'N' || s_nationkey ELSE '' END AS author,
           CASE WHEN s_acctbal > 0 THEN CAST(s_suppkey AS VARCHAR) ELSE '0' END AS appreciations,
           CASE WHEN s_acctbal > 0 THEN s_nationkey || 'K' ELSE '0' END AS views,
           CASE WHEN s_acctbal > 4000 THEN 1 ELSE 0 END AS featured,
           coalesce(pages.url, CASE WHEN s_nationkey > 3 THEN '' END) AS url,
           '/i/' || s_suppkey || '.png' AS image_url, 'pic' AS image_alt
    FROM supplier LEFT JOIN pages ON page_id = s_suppkey) WHERE title IS NOT NULL)"""
_ATTR = f"""attr AS (
  SELECT {_PART_POS}, p_partkey, p_size || ' hours ago' AS time_posted,
         CASE WHEN p_size >= 10 THEN p_size || '%' ELSE '' END AS discount, p_name || ' & "' || p_type || '"' AS title,
         format('{{:,.2f}}', p_retailprice) AS original_price, CASE WHEN p_type <> 'ECONOMY' THEN p_brand ELSE '' END AS special_price,
         '/go?id=' || p_partkey || '&r=1' AS shop_link FROM part)"""
ORACLE = {
    "deal_cards": f"WITH {DEALS_SQL} SELECT page_id, position, {_DEAL_FIELDS} FROM deals",
    "deal_cards_search": f"WITH {DEALS_SQL} SELECT page_id, position, {_DEAL_FIELDS}, product_url FROM deals",
    "bad_rows": f"""
WITH {DEALS_SQL} SELECT page_id, position, 'price_not_numeric' AS reason FROM deals WHERE current_price = 'call us'""",
    "deal_cards_attr": f"""
WITH {_ATTR} SELECT page_id, position, time_posted, discount, title, original_price, special_price, shop_link,
       CAST(page_id AS VARCHAR) AS page_number FROM attr""",
    "asset_cards": f"""
SELECT {_PART_POS}, p_name AS title, CASE WHEN p_size > 5 THEN p_brand ELSE 'N/A' END AS creator,
       CASE WHEN p_type <> 'ECONOMY' THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) ELSE 'N/A' END AS price,
       CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) ELSE '0' END AS likes FROM part""",
    "job_cards": f"""
SELECT {_CUST_POS}, 'Clerk ' || c_custkey AS title, c_name AS company,
       CASE WHEN c_acctbal > 0 THEN 'Nation ' || c_nationkey ELSE 'N/A' END AS location,
       'Sells ' || c_mktsegment || ' & more' AS description,
       CASE WHEN c_acctbal > 5000 THEN c_nationkey || ' days ago' ELSE 'N/A' END AS posted FROM customer""",
    "project_cards": f"WITH {_PROJECTS} SELECT * FROM projects",
    "enrich_featured": f"""
WITH {_PROJECTS},
five AS (SELECT DISTINCT url FROM (SELECT url FROM projects WHERE featured = 1 AND url <> '' ORDER BY page_id, position LIMIT 5)),
holders AS (SELECT url, min(page_id * 1000 + position) AS spot FROM projects JOIN five USING (url) GROUP BY url),
texts AS (SELECT spot, substr({sql_text('html')}, 1, 1000) || '...' AS detailed_content FROM pages JOIN holders USING (url))
SELECT p.page_id, position, title, url, detailed_content FROM projects p LEFT JOIN texts ON spot = p.page_id * 1000 + position""",
    "sample_head": f"""
WITH {_PROJECTS} SELECT row_number() OVER (ORDER BY page_id, position) AS number, title, author, url FROM projects
ORDER BY page_id, position LIMIT 3""",
    "pagination_count": """
SELECT s_suppkey, CASE WHEN s_nationkey = 0 THEN 1 WHEN s_nationkey < 24 THEN s_nationkey END AS n_pages FROM supplier""",
    "take_target": f"""
WITH {DEALS_SQL} SELECT page_id, position, product_name FROM deals WHERE position < 7""",
    "take_target_filtered": f"""
WITH {DEALS_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY position) AS rn FROM deals WHERE discount IS NOT NULL)
SELECT page_id, position, product_name FROM k WHERE rn <= 7""",
    "target_shortfall": """
SELECT p_partkey // 20 AS page_id, count(*) AS n_found, least(count(*), 25) AS n_taken, 25 - least(count(*), 25) AS shortfall,
       least(count(*), 25) / 25.0 AS progress FROM part GROUP BY 1
UNION ALL SELECT DISTINCT p_partkey // 20 + 1000000, 0, 0, 25, 0.0 FROM part WHERE p_partkey // 20 % 5 = 0""",
    "search_fallback": f"""
WITH {DEALS_SQL} SELECT p_brand AS store,
       CASE WHEN CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) <= 12 THEN 'store' ELSE 'global' END AS origin,
       product_name, current_price, product_url FROM deals WHERE contains(lower(product_name), 'ring')""",
    "store_lookup": """
WITH f AS (SELECT o_orderpriority AS name, min(o_orderkey) AS k FROM orders GROUP BY 1),
s AS (SELECT event_id, CASE event_type WHEN 'click' THEN '1-URGENT' WHEN 'view' THEN '2-HIGH' WHEN 'signup' THEN '3-MEDIUM'
             WHEN 'purchase' THEN '5-LOW' ELSE 'unknown' END AS name FROM events)
SELECT event_id, s.name, 'order-' || k AS slug FROM s LEFT JOIN f ON s.name = f.name""",
    "harvest_deals": f"""
WITH {_ATTR} SELECT '{BASE}/store/s' || (page_id // 10) || '?page=' || (1 + page_id % 10) AS url,
       CAST(1 + page_id % 10 AS VARCHAR) AS page_number, position, title, shop_link FROM attr""",
    "harvest_rejects": f"""
WITH have AS (SELECT DISTINCT p_partkey // 20 AS page_id FROM part),
want AS (SELECT DISTINCT page_id // 10 AS s FROM have), f AS (SELECT s, unnest(range(1, 12)) AS n FROM want)
SELECT '{BASE}/store/s' || s || '?page=' || n AS url, 'not_fetched' AS reason FROM f
WHERE n = 11 OR s * 10 + n - 1 NOT IN (SELECT page_id FROM have)""",
}
