"""Table access, fixtures derived from the given tables, and small SQL text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = "https://deals.example.com"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rx(expr: str, steps: list[tuple[str, str]]) -> str:
    """SQL text of a chain of global regular-expression replacements."""
    for pattern, to in steps:
        expr = f"regexp_replace({expr}, {quote(pattern)}, {quote(to)}, 'g')"
    return expr


# --- stored runs -------------------------------------------------------------------------------

MODEL_OF_EVENT = {
    "click": "gpt-4o-mini", "view": "gpt-4o-2024-08-06", "signup": "gemini-1.5-flash",
    "error": "Llama3.1 8B", "purchase": "Groq Llama3.1 70b",
}


def model_of_event() -> Column:
    pairs = [x for kv in MODEL_OF_EVENT.items() for x in map(F.lit, kv)]
    return F.try_element_at(F.create_map(*pairs), F.col("event_type"))


MODEL_SQL = (
    "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MODEL_OF_EVENT.items()) + " END"
)


def shop_url() -> Column:
    return F.concat(F.lit("https://shop"), F.col("user_id"), F.lit(".example.com/"))


def run_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(metadata, listings, token_costs) as projections of ``events``; a run whose reply was empty
    (``value`` below 1) has no token row."""
    from pagesmith.operators.pricing import cost_expr, pricing_table

    events = table(spark, sf, "events")
    metadata = events.select(
        F.col("event_id").alias("id"), shop_url().alias("url"), F.col("ts").alias("timestamp"),
        F.lit(None).cast("string").alias("raw_data"),
        F.lit(None).cast("string").alias("markdown_data"), model_of_event().alias("model_used"),
    )
    tokens = events.where(F.col("value") >= 1).select(
        F.col("event_id").alias("scrape_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("input_tokens"),
        F.floor("value").cast("bigint").alias("output_tokens"),
        model_of_event().alias("model_name"),
    )
    rates = F.broadcast(pricing_table(spark))
    costs = tokens.join(rates, F.col("model_name") == F.col("model")).select(
        "scrape_id", "input_tokens", "output_tokens",
        cost_expr(F.col("input_tokens"), F.col("output_tokens")).alias("total_cost"), "model_name",
    )
    listings = events.select(
        F.col("event_id").alias("scrape_id"),
        F.to_json(F.struct("event_type", F.col("value").cast("decimal(12,2)").cast("string").alias("value"))).alias("data"),
    )
    return metadata, listings, costs


PRICING_SQL = (
    "(VALUES ('gpt-4o-mini', 0.000000150000, 0.000000600000), "
    "('gpt-4o-2024-08-06', 0.000002500000, 0.000010000000), "
    "('gemini-1.5-flash', 0.000000075000, 0.000000300000), "
    "('Llama3.1 8B', 0.000000000000, 0.000000000000), "
    "('Groq Llama3.1 70b', 0.000000000000, 0.000000000000), "
    "('whisper-large-v3', 0.000000150000, 0.000000600000), "
    "('chatgpt', 0.000000150000, 0.000000600000)) AS pr(model, input_rate, output_rate)"
)
RUNS_SQL = f"""runs AS (
  SELECT event_id AS id, 'https://shop' || user_id || '.example.com/' AS url, ts,
         {MODEL_SQL} AS model_used,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS input_tokens,
         CAST(floor(value) AS BIGINT) AS output_tokens
  FROM events WHERE value >= 1),
priced AS (
  SELECT runs.*, CAST(input_tokens AS DECIMAL(15,0)) * CAST(input_rate AS DECIMAL(14,12))
               + CAST(output_tokens AS DECIMAL(15,0)) * CAST(output_rate AS DECIMAL(14,12)) AS total_cost
  FROM runs JOIN {PRICING_SQL} ON model = model_used)"""


def second_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


# --- pages with cards, tables and pagers, made from rows -----------------------------------------

CARDS_PER_PAGE = 20


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by the keys of the grouping that follows (which then needs no other shuffle),
    with a fixed count: the pages made from small rows are read by costly expressions."""
    spark = rows.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(n, *keys)


def pages_of_cards(rows: DataFrame, key: str, card: Column, url: Column,
                   per_page: int = CARDS_PER_PAGE) -> DataFrame:
    """Page table with at most ``per_page`` cards a page, in key order, framed by other markup."""
    page = F.floor(F.col(key) / per_page).cast("bigint").alias("page_id")
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), card.alias("c")))), lambda r: r["c"]),
        "\n",
    )
    grouped = dealt(rows.withColumn("page_id", page), "page_id").groupBy("page_id").agg(body.alias("body"))
    html = F.concat(
        F.lit('<html><body><!-- <div class="product-item-detail">no card</div> --><div class="row">'),
        F.col("body"),
        F.lit('</div><p class="price">outside</p><h3>outside</h3></body></html>'),
    )
    return grouped.select("page_id", url.alias("url"), html.alias("html"))


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def deal_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Field texts of one deal per part; NULL where the card lacks the element."""
    price = F.concat(F.lit("₹"), F.format_number("p_retailprice", 2))
    return table(spark, sf, "part").select(
        "p_partkey", "p_brand",
        F.concat("p_name", F.lit(" & "), "p_type").alias("product_name"),
        F.when(F.col("p_brand") == "Brand#3", F.lit("call us")).otherwise(price).alias("current_price"),
        F.when(F.col("p_type") != "ECONOMY", F.concat(F.lit("₹"), F.col("p_size"))).alias("special_price"),
        F.when(F.col("p_size") >= 10, F.concat(F.col("p_size"), F.lit("% off"))).alias("discount"),
        F.when(~F.startswith("p_name", F.lit("red")),
               F.concat(F.lit("/img/"), F.col("p_partkey"), F.lit(".png?a=1&b=2"))).alias("image_url"),
        F.concat(F.lit("/p/"), F.col("p_partkey")).alias("product_url"),
    )


def _or_nothing(*parts: Column) -> Column:
    return F.coalesce(F.concat(*parts), F.lit(""))


def deal_card() -> Column:
    c, lit = F.col, F.lit
    return F.concat(
        lit('<div id="x" class="col product-item-detail"><a href="'), c("product_url"),
        lit('"><div class="pic">'),
        _or_nothing(lit('<img class="lazy" data-src="'), escaped(c("image_url")), lit('" src="/blank.gif">')),
        lit("</div></a><h3>\n  "), escaped(c("product_name")), lit(" </h3>"),
        _or_nothing(lit('<p class="price">'), c("current_price"), lit("</p>")),
        _or_nothing(lit('<p class="spacail-price"><b>'), c("special_price"), lit("</b> </p>")),
        _or_nothing(lit('<div class="box"><div class=\'discount\'>'), c("discount"), lit("</div></div>")),
        lit("</div>"),
    )


def deal_pages(spark: SparkSession, sf: str) -> DataFrame:
    url = F.concat(F.lit(f"{BASE}/store/all?page="), F.col("page_id"), F.lit("&ref=x"))
    return pages_of_cards(deal_rows(spark, sf), "p_partkey", deal_card(), url)


DEALS_SQL = f"""deals AS (
  SELECT p_partkey // {CARDS_PER_PAGE} AS page_id,
         '{BASE}/store/all?page=' || (p_partkey // {CARDS_PER_PAGE}) || '&ref=x' AS url,
         row_number() OVER (PARTITION BY p_partkey // {CARDS_PER_PAGE} ORDER BY p_partkey) - 1 AS position,
         p_brand, p_partkey,
         p_name || ' & ' || p_type AS product_name,
         CASE WHEN p_brand = 'Brand#3' THEN 'call us' ELSE '₹' || format('{{:,.2f}}', p_retailprice) END AS current_price,
         CASE WHEN p_type <> 'ECONOMY' THEN '₹' || p_size END AS special_price,
         CASE WHEN p_size >= 10 THEN p_size || '% off' END AS discount,
         CASE WHEN NOT starts_with(p_name, 'red') THEN '/img/' || p_partkey || '.png?a=1&b=2' END AS image_url,
         '/p/' || p_partkey AS product_url
  FROM part)"""


# --- SQL text of the page conversions ------------------------------------------------------------

_INERT = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
_BLOCK_NAMES = (
    "p|div|article|section|main|nav|aside|ul|ol|dl|table|tbody|thead|form|figure|address|body|html"
)


def sql_decode(expr: str) -> str:
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        expr = f"replace({expr}, '&{name};', '{char}')"
    return expr


def sql_clean(expr: str) -> str:
    return rx(expr, [(r"(?is)<header\b[^>]*>.*?</header\s*>", ""), (r"(?is)<footer\b[^>]*>.*?</footer\s*>", "")])


def sql_strip_inert(expr: str) -> str:
    return rx(expr, [(_INERT, "")])


def sql_trim(expr: str) -> str:
    return f"trim({expr}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))"


def sql_markdown(expr: str) -> str:
    text = rx(sql_clean(expr), [(_INERT + r"|<head\b[^>]*>.*?</head\s*>", ""), (r"[ \t\r\n\f]+", " ")])
    text = rx(text, [(rf"(?i) ?<h{n}\b[^>]*> ?", "\n\n" + "#" * n + " ") for n in range(1, 7)])
    text = rx(text, [
        (r"(?i) ?<br ?/?> ?", "  \n"),
        (r"(?i) ?<li\b[^>]*> ?", "\n  * "),
        (r"(?i)</?(?:b|strong)(?:\s[^>]*)?>", "**"),
        (r'(?i)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a ?>', r"[\2](\1)"),
        (rf"(?i) ?</?(?:{_BLOCK_NAMES}|h[1-6])(?:\s[^>]*)?> ?", "\n\n"),
        (r"<[^>]*>", ""),
    ])
    tidy = rx(sql_decode(text), [(r"\n(?: *\n){2,}", "\n\n"), (r"\n ([^ ])", "\n\\1")])
    return sql_trim(tidy)


def sql_text(expr: str) -> str:
    text = rx(expr, [
        (_INERT + r"|<head\b[^>]*>.*?</head\s*>", ""),
        (r"[ \t\r\n\f]+", " "),
        (rf"(?i) ?</?(?:br|{_BLOCK_NAMES}|h[1-6]|li|tr|header|footer)(?:\s[^>]*)?/?> ?", "\n"),
        (r"<[^>]*>", ""),
    ])
    return sql_trim(rx(sql_decode(text), [(r" *\n[ \n]*", "\n")]))
