"""Chunks, prompts, replies, listings, tokens and cost."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import functions as F

from pagesmith.cluster import shared_folder, spread
from pagesmith.functions import replies as R
from pagesmith.functions.tokens import count_tokens as tokens_of
from pagesmith.functions.tokens import trim_to_tokens as trim
from pagesmith.operators import listings as L
from pagesmith.operators import pricing as P
from pagesmith.operators import providers as V
from pagesmith.operators.runs import read_runs
from pagesmith.plans import extract as X

from .common import MODEL_SQL, PRICING_SQL, model_of_event, quote, sql_markdown, table

FIELDS = ["title", "href", "note"]
MODEL = "gpt-4o-mini"


# --- chunks and tokens -------------------------------------------------------------------------


def _documents(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"))


def chunk_text(spark, sf):
    return L.chunk_rows(_documents(spark, sf))


def chunk_text_small(spark, sf):
    return L.chunk_rows(_documents(spark, sf), 500, 50)


def chunk_invariants(spark, sf):
    """Per text: every chunk within size, part of the text, in order, and no visible character lost."""
    docs = _documents(spark, sf)
    blank = lambda c: F.regexp_replace(c, r"\s+", "")
    # the whole text's visible characters are counted once per text, not once per chunk
    whole = docs.withColumns({"whole": F.col("text"), "whole_visible": F.length(blank(F.col("text")))})
    chunks = L.chunk_rows(whole, 500, 50)
    at = F.instr(F.col("whole"), F.col("text"))
    per_doc = chunks.groupBy("doc_id").agg(
        (F.max(F.length("text")) <= 500).cast("int").alias("within_size"),
        F.min((at > 0).cast("int")).alias("in_text"),
        (F.sum(F.length(blank(F.col("text")))) >= F.max("whole_visible")).cast("int").alias("complete"),
        (F.max("chunk_idx") + 1 == F.count(F.lit(1))).cast("int").alias("numbered"),
    )
    return docs.select("doc_id").join(per_doc, "doc_id", "left")


def count_tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tokens_of(F.col("text")).alias("n_tokens"))


def trim_to_tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(trim(F.col("text"), 100)).alias("text_md5"))


def build_prompts(spark, sf):
    prompts = L.build_prompts(table(spark, sf, "documents"), FIELDS)
    return prompts.select("doc_id", F.md5("prompt").alias("prompt_md5"), F.length("prompt").alias("n_chars"))


# --- extraction over pages -----------------------------------------------------------------------


def _pages(spark, sf):
    return spread(table(spark, sf, "pages").select("page_id", "html"))


def extract_listings(spark, sf):
    text = X.page_markdown(_pages(spark, sf)).withColumn("chunk_idx", F.lit(0))
    replies = V.rule_replies(L.build_prompts(text, FIELDS), FIELDS)
    return replies.select("scrape_id", F.md5("reply").alias("reply_md5"), "input_tokens", "output_tokens")


def _python_links(prompt: str) -> tuple[str, int, int]:
    found = re.findall(r"\[([^\]\[]*)\]\(([^)]*)\)", prompt)
    reply = json.dumps({"listings": [{"title": t, "href": h} for t, h in found]}, ensure_ascii=False)
    return reply, len(prompt), len(found)


def provider_listings(spark, sf):
    """The same links found by a Python provider that is called for every chunk in parallel."""
    text = X.page_markdown(_pages(spark, sf)).withColumn("chunk_idx", F.lit(0))
    replies = V.call_provider(L.build_prompts(text, FIELDS), _python_links)
    parsed = L.fill_listings(L.parse_replies(replies, FIELDS), FIELDS)
    return L.flatten_listings(parsed, FIELDS)


def extract_run(spark, sf):
    """Flagship: default chunk sizes, all steps, one response row per page."""
    result = X.extract_pages(_pages(spark, sf), FIELDS, MODEL, P.pricing_table(spark))
    return _flat_response(X.response_records(result, FIELDS))


def response_record(spark, sf):
    """As :func:`extract_run` with chunks larger than any page, which SQL can follow."""
    options = X.Options(chunk_size=10_000_000)
    result = X.extract_pages(_pages(spark, sf), FIELDS, MODEL, P.pricing_table(spark), options=options)
    return _flat_response(X.response_records(result, FIELDS))


def store_extraction(spark, sf):
    """Extraction carried into stored runs, as two batches of one day, and read back per page."""
    pages = spread(table(spark, sf, "pages"))
    folder, pricing, started = f"{shared_folder(spark)}/runs-{uuid.uuid4().hex}", P.pricing_table(spark), F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    options = X.Options(chunk_size=10_000_000)
    for rest in (0, 1):
        part = pages.where(F.col("page_id") % 2 == rest)
        result = X.extract_pages(part, FIELDS, MODEL, pricing, options=options)
        X.store_extraction(folder, f"batch-{rest}", part, result, FIELDS, started, MODEL, pricing, options)
    metadata, listings, costs = read_runs(spark, folder)
    found = listings.groupBy("scrape_id").agg(F.count("*").alias("n_listings"))
    kept = metadata.select(F.col("id").alias("scrape_id"), "url", F.md5("raw_data").alias("raw_md5"), F.col("model_used").alias("model"))
    rows = kept.join(costs.select("scrape_id", "input_tokens"), "scrape_id").join(found, "scrape_id", "left")
    return rows.select(F.col("scrape_id").alias("run_id"), "url", "raw_md5", "model", "input_tokens", F.coalesce("n_listings", F.lit(0)).alias("n_listings"))


def asked_once(spark, sf):
    """Replies of a provider that is asked each distinct prompt once: whole texts, copies among them. Those of three
    sources, and their copies, are stored already."""
    prompts = L.build_prompts(table(spark, sf, "documents").select("doc_id", "source", "text"), FIELDS).withColumn("model", F.lit(MODEL))
    ask = lambda rows: V.rule_replies(rows, FIELDS, rule=lambda text, _: F.concat(F.lit("asked "), F.md5(text)))
    key = F.sha2(F.concat_ws(" ", "model", "prompt"), 256)
    old = prompts.where(F.col("source").isin("src1", "src2", "src3")).withColumn("prompt_key", key)
    stored = V.reply_table(V.rule_replies(old, FIELDS, rule=lambda text, _: F.concat(F.lit("stored "), F.md5(text)))).dropDuplicates(["prompt_key"])
    return V.ask_once(prompts, ask, stored).select("doc_id", "reply", "input_tokens")


def _flat_response(rows):
    return rows.select(
        "scrape_id", "part", F.size("data").alias("n_listings"), F.md5(F.to_json("data")).alias("data_md5"),
        "tokens.input_tokens", "tokens.output_tokens", F.round("cost", 10).alias("cost"), "model",
    )


# --- replies made from rows ----------------------------------------------------------------------

REPLY_FIELDS = ["Product Name", "Price", "Rating"]


def _replies(spark, sf):
    """One reply per part. STANDARD parts reply well, the other types each break in their own way,
    and the calls of brand 13 fail."""
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    full = F.to_json(F.struct(F.col("p_name").alias("Product Name"), price.alias("Price"), F.col("p_size").alias("Rating")))
    short = F.to_json(F.struct(F.col("p_brand").alias("Product Name"), F.lit("1").alias("Price"), F.lit(True).alias("Extra")))
    good = F.concat(F.lit('{"listings":['), full, F.lit(","), short, F.lit("]}"))
    reply = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit('{"listings":['), full, F.lit(","), short, F.lit(',{"Price":"1')))
        .when(F.col("p_type") == "PROMO", F.concat(F.lit("Sorry: "), F.col("p_name")))
        .when(F.col("p_type") == "LARGE", F.lit("[1, 2]"))
        .when(F.col("p_type") == "SMALL", F.concat(F.lit('{"listings":['), full, F.lit(',{"Product Name":"cut')))
        .otherwise(good)
    )
    failed = F.col("p_brand") == "Brand#13"
    return table(spark, sf, "part").select(
        F.col("p_size").cast("bigint").alias("scrape_id"), F.col("p_partkey").alias("chunk_idx"),
        F.when(~failed, reply).alias("reply"), F.length("p_name").alias("input_tokens"),
        F.when(F.col("p_size") > 3, F.col("p_size")).alias("output_tokens"),
        F.when(failed, "TimeoutError: no answer").alias("error"),
    )


def parse_listings(spark, sf):
    parsed = L.parse_replies(_replies(spark, sf), REPLY_FIELDS)
    return parsed.select("scrape_id", "chunk_idx", "status", F.size("listings").alias("n"), "input_tokens", "output_tokens")


def repair_json(spark, sf):
    rows = _replies(spark, sf).where(F.col("reply").isNotNull())
    out = rows.withColumns({"fixed": R.repair_reply(F.col("reply")), "compat": R.repair_reply(F.col("reply"), True)})
    count = lambda c: F.size(R.parse_reply(F.col(c), REPLY_FIELDS)["listings"])
    return out.select("chunk_idx", F.md5("fixed").alias("fixed_md5"), count("fixed").alias("n_fixed"), F.md5("compat").alias("compat_md5"), count("compat").alias("n_compat"))


def _renamed(rows):
    return rows.withColumnsRenamed({"Product Name": "product_name", "Price": "price", "Rating": "rating"})


def fill_fields(spark, sf):
    parsed = L.fill_listings(L.parse_replies(_replies(spark, sf), REPLY_FIELDS), REPLY_FIELDS)
    return _renamed(L.flatten_listings(parsed, REPLY_FIELDS))


def fill_fields_map(spark, sf):
    """Map form: the unrequested field is kept next to the filled ones."""
    record = R.parse_reply_map(F.col("reply"))["listings"]
    rows = _replies(spark, sf).select("scrape_id", "chunk_idx", F.posexplode(record).alias("pos", "r"))
    filled = rows.withColumn("r", R.fill_map(F.col("r"), REPLY_FIELDS))
    return filled.select("scrape_id", "chunk_idx", "pos", *[
        F.try_element_at("r", F.lit(k)).alias(a) for k, a in
        (("Product Name", "product_name"), ("Price", "price"), ("Rating", "rating"), ("Extra", "extra"))
    ])


def flatten_listings(spark, sf):
    parsed = L.parse_replies(_replies(spark, sf), REPLY_FIELDS, repair=True)
    return _renamed(L.flatten_listings(parsed, REPLY_FIELDS)).drop("rating")


def merge_listings(spark, sf):
    items = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("scrape_id"), F.col("l_linenumber").alias("chunk_idx"), F.col("l_orderkey").alias("pos"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("state"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
    )
    return L.merge_listings(items, ["flag", "state", "quantity"])


def token_totals(spark, sf):
    return L.token_totals(L.parse_replies(_replies(spark, sf), REPLY_FIELDS))


def failed_chunks(spark, sf):
    return L.failed_chunks(L.parse_replies(_replies(spark, sf), REPLY_FIELDS))


def listing_counts(spark, sf):
    counts = L.run_counts(L.parse_replies(_replies(spark, sf), REPLY_FIELDS))
    return counts.select("scrape_id", "n_chunks", "n_failed", "n_found")


def _priced_events(spark, sf):
    model = F.when(F.col("value") > 300, F.lit("gpt-0")).otherwise(model_of_event())
    runs = table(spark, sf, "events").select(
        "event_id", model.alias("model"), F.get_json_object("props", "$.k").cast("bigint").alias("input_tokens"),
        F.floor("value").cast("bigint").alias("output_tokens"),
    )
    return P.price_runs(runs, P.pricing_table(spark))


def calculate_price(spark, sf):
    return _priced_events(spark, sf)[0].select("event_id", "input_tokens", "output_tokens", F.round(F.col("cost").cast("double"), 10).alias("cost"))


def supported_models(spark, sf):
    return _priced_events(spark, sf)[1].groupBy("model", "reason").agg(F.count(F.lit(1)).alias("n_runs"))


def unwrap_container(spark, sf):
    body = F.concat(F.lit('[{"name":"'), "p_name", F.lit('"}]'))
    reply = (
        F.when(F.col("p_type") == "ECONOMY", body)
        .when(F.col("p_type") == "PROMO", F.concat(F.lit('{"a":'), body, F.lit(',"b":1}')))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit('"'), "p_name", F.lit('"')))
        .when(F.col("p_type") == "SMALL", F.concat(F.lit('{"a":'), body))
        .otherwise(F.concat(F.lit('{"listings":'), body, F.lit("}")))
    )
    out = R.unwrap_container(reply)
    return table(spark, sf, "part").select("p_partkey", out["kind"].alias("kind"), out["payload"].alias("payload"))


QUERIES = {
    f.__name__: f
    for f in (
        chunk_text, chunk_text_small, chunk_invariants, count_tokens, trim_to_tokens, build_prompts,
        extract_listings, provider_listings, extract_run, response_record, store_extraction, asked_once, parse_listings, repair_json,
        fill_fields, fill_fields_map, flatten_listings, merge_listings, token_totals, failed_chunks,
        listing_counts, calculate_price, supported_models, unwrap_container,
    )
}

_PROMPT_HEAD = quote(R.system_prompt(FIELDS) + "\n" + R.USER_PROMPT)
_LINK = quote(r"\[([^\]\[]*)\]\(([^)]*)\)")
_MD = f"md AS (SELECT page_id AS scrape_id, {sql_markdown('html')} AS text FROM pages)"
_LINKS = f"""{_MD},
links AS (SELECT scrape_id, unnest(regexp_extract_all(text, {_LINK}, 1)) AS title,
            unnest(regexp_extract_all(text, {_LINK}, 2)) AS href,
            unnest(range(len(regexp_extract_all(text, {_LINK})))) AS pos FROM md)"""
_REPLY = """r AS (
  SELECT p_size AS scrape_id, p_partkey AS chunk_idx, p_name, p_brand, p_size, p_type,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS price, length(p_name) AS in_t,
         CASE WHEN p_size > 3 THEN p_size ELSE 0 END AS out_t, p_brand = 'Brand#13' AS failed,
         p_type NOT IN ('ECONOMY', 'PROMO', 'LARGE', 'SMALL') AS good,
         '{"Product Name":"' || p_name || '","Price":"' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) || '","Rating":' || p_size || '}' AS j1,
         '{"Product Name":"' || p_brand || '","Price":"1","Extra":true}' AS j2 FROM part),
s AS (SELECT *, CASE WHEN failed THEN 'failed' WHEN good THEN 'ok' WHEN p_type = 'LARGE' THEN 'no_object' ELSE 'invalid' END AS status FROM r),
t AS (SELECT *, CASE WHEN status IN ('ok', 'no_object') THEN in_t ELSE 0 END AS input_tokens,
             CASE WHEN status IN ('ok', 'no_object') THEN out_t ELSE 0 END AS output_tokens FROM s)"""
_REPAIR = """f AS (SELECT *, CASE WHEN good THEN '{"listings":[' || j1 || ',' || j2 || ']}'
    WHEN p_type = 'ECONOMY' THEN '{"listings":[' || j1 || ',' || j2 || ',{"Price":"1'
    WHEN p_type = 'SMALL' THEN '{"listings":[' || j1 || ',{"Product Name":"cut'
    WHEN p_type = 'LARGE' THEN '[1, 2]' ELSE 'Sorry: ' || p_name END AS reply FROM t WHERE NOT failed)"""


def _chunks_sql(size: int, overlap: int, source: str = "SELECT doc_id, text FROM documents") -> str:
    """CTEs ending in ``chunks(doc_id, chunk_idx, text)``: the splitting rule over sets.

    The pieces of the coarsest separator, and the finer pieces of those that are too long, are
    borders (offsets) of runs; recursion walks the windows over each run's borders. No word of
    these texts reaches the chunk size, so the level of single characters is left out."""
    return f"""
RECURSIVE d0 AS ({source}),
d AS (SELECT doc_id, text, CASE WHEN contains(text, chr(10) || chr(10)) THEN chr(10) || chr(10)
                                WHEN contains(text, chr(10)) THEN chr(10) ELSE ' ' END AS sep FROM d0),
p0 AS (SELECT doc_id, sep, unnest(string_split(text, sep)) AS s, unnest(range(len(string_split(text, sep)))) AS i FROM d),
p1 AS (SELECT doc_id, sep, i, CASE WHEN i > 0 THEN sep || s ELSE s END AS s FROM p0 WHERE i > 0 OR s <> ''),
p2 AS (SELECT *, length(s) AS n, CAST(sum(length(s)) OVER w - length(s) AS BIGINT) AS a,
              sum(CASE WHEN length(s) >= {size} THEN 1 ELSE 0 END) OVER w * 2 - CASE WHEN length(s) >= {size} THEN 1 ELSE 0 END AS run
       FROM p1 WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)),
long AS (SELECT doc_id, run, a, s, CASE WHEN length(sep) = 2 THEN chr(10) ELSE ' ' END AS sep FROM p2 WHERE n >= {size}),
sub0 AS (SELECT doc_id, run, a, sep, unnest(string_split(s, sep)) AS s, unnest(range(len(string_split(s, sep)))) AS i FROM long),
sub1 AS (SELECT doc_id, run, a, sep, i, CASE WHEN i > 0 THEN sep || s ELSE s END AS s FROM sub0),
sub AS (SELECT doc_id, run, sep, s, length(s) AS n, CAST(a + sum(length(s)) OVER w - length(s) AS BIGINT) AS a,
               sum(CASE WHEN length(s) >= {size} THEN 1 ELSE 0 END) OVER w * 2 - CASE WHEN length(s) >= {size} THEN 1 ELSE 0 END AS run2
        FROM sub1 WINDOW w AS (PARTITION BY doc_id, run ORDER BY i ROWS UNBOUNDED PRECEDING)),
word0 AS (SELECT doc_id, run, run2, a, unnest(string_split(s, ' ')) AS s, unnest(range(len(string_split(s, ' ')))) AS i
          FROM sub WHERE n >= {size} AND sep = chr(10)),
word1 AS (SELECT doc_id, run, run2, a, i, CASE WHEN i > 0 THEN ' ' || s ELSE s END AS s FROM word0),
word AS (SELECT doc_id, run, run2, length(s) AS n, CAST(a + sum(length(s)) OVER w - length(s) AS BIGINT) AS a
         FROM word1 WINDOW w AS (PARTITION BY doc_id, run, run2 ORDER BY i ROWS UNBOUNDED PRECEDING)),
borders AS (SELECT doc_id, run, 0 AS run2, a AS start, a + n AS stop FROM p2 WHERE n < {size}
            UNION ALL SELECT doc_id, run, run2, a, a + n FROM sub WHERE n < {size}
            UNION ALL SELECT doc_id, run, run2, a, a + n FROM word),
runs AS (SELECT doc_id, run * 100000 + run2 AS run, list_sort(list_distinct(list(start) || list(stop))) AS cuts FROM borders GROUP BY ALL),
ends(doc_id, run, f, e) AS (
  SELECT doc_id, run, 1, greatest(2, len(list_filter(cuts, lambda c: c - cuts[1] <= {size}))) FROM runs
  UNION ALL
  SELECT doc_id, run, nf, greatest(nf + 1, len(list_filter(cuts, lambda c: c - cuts[nf] <= {size}))) FROM (
    SELECT doc_id, run, cuts, 1 + len(list_filter(cuts, lambda c: cuts[e] - c > {overlap} OR cuts[e + 1] - c > {size})) AS nf
    FROM ends JOIN runs USING (doc_id, run) WHERE e < len(cuts))),
pieces AS (SELECT doc_id, run, f, trim(substr(text, cuts[f] + 1, cuts[e] - cuts[f]), ' ' || chr(9) || chr(10) || chr(13) || chr(160)) AS text
           FROM ends JOIN runs USING (doc_id, run) JOIN d0 USING (doc_id)),
chunks AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY run, f) - 1 AS chunk_idx, text FROM pieces WHERE text <> '')"""


_PAGE_TEXT = f"SELECT page_id AS doc_id, {sql_markdown('html')} AS text FROM pages"
_EXTRACT_RUN = f"""
WITH {_chunks_sql(10_000, 1_000, _PAGE_TEXT)},
links AS (SELECT doc_id, chunk_idx, unnest(regexp_extract_all(text, {_LINK}, 1)) AS title,
            unnest(regexp_extract_all(text, {_LINK}, 2)) AS href, unnest(range(len(regexp_extract_all(text, {_LINK})))) AS pos FROM chunks),
j AS (SELECT doc_id, chunk_idx, string_agg('{{"title":"' || title || '","href":"' || href || '"}}', ',' ORDER BY pos) AS body FROM links GROUP BY ALL),
r AS (SELECT doc_id, text, '{{"listings":[' || coalesce(body, '') || ']}}' AS reply FROM chunks LEFT JOIN j USING (doc_id, chunk_idx)),
k AS (SELECT doc_id, CAST(sum(ceil(length({_PROMPT_HEAD} || text) / 4.0)) AS BIGINT) AS input_tokens,
             CAST(sum(ceil(length(reply) / 4.0)) AS BIGINT) AS output_tokens FROM r GROUP BY 1),
m AS (SELECT doc_id, title, href, min(chunk_idx * 1000000 + pos) AS spot FROM links GROUP BY ALL),
b AS (SELECT doc_id, count(*) AS n, string_agg('{{"title":"' || title || '","href":"' || href || '","note":""}}', ',' ORDER BY spot) AS body FROM m GROUP BY 1)
SELECT doc_id AS scrape_id, 0 AS part, coalesce(n, 0) AS n_listings, md5('[' || coalesce(body, '') || ']') AS data_md5, input_tokens, output_tokens,
       round(CAST(input_tokens * 0.000000150000 + output_tokens * 0.000000600000 AS DOUBLE), 10) AS cost, '{MODEL}' AS model
FROM k LEFT JOIN b USING (doc_id)"""

ORACLE = {
    "chunk_text": f"WITH {_chunks_sql(10_000, 1_000)} SELECT * FROM chunks",
    "chunk_text_small": f"WITH {_chunks_sql(500, 50)} SELECT * FROM chunks",
    "chunk_invariants": "SELECT doc_id, 1 AS within_size, 1 AS in_text, 1 AS complete, 1 AS numbered FROM documents",
    "count_tokens": "SELECT doc_id, CAST(ceil(length(text) / 4.0) AS BIGINT) AS n_tokens FROM documents",
    "trim_to_tokens": "SELECT doc_id, md5(substr(text, 1, 400)) AS text_md5 FROM documents",
    "build_prompts": f"""
SELECT doc_id, md5({_PROMPT_HEAD} || text) AS prompt_md5, length({_PROMPT_HEAD} || text) AS n_chars FROM documents""",
    "extract_run": _EXTRACT_RUN,
    "extract_listings": f"""
WITH {_LINKS},
j AS (SELECT scrape_id, string_agg('{{"title":"' || title || '","href":"' || href || '"}}', ',' ORDER BY pos) AS body FROM links GROUP BY 1),
r AS (SELECT scrape_id, text, '{{"listings":[' || coalesce(body, '') || ']}}' AS reply FROM md LEFT JOIN j USING (scrape_id))
SELECT scrape_id, md5(reply) AS reply_md5, CAST(ceil(length({_PROMPT_HEAD} || text) / 4.0) AS BIGINT) AS input_tokens,
       CAST(ceil(length(reply) / 4.0) AS BIGINT) AS output_tokens FROM r""",
    "provider_listings": f"WITH {_LINKS} SELECT scrape_id, 0 AS chunk_idx, pos, title, href, '' AS note FROM links",
    "store_extraction": f"""
WITH {_LINKS},
k AS (SELECT scrape_id, CAST(ceil(length({_PROMPT_HEAD} || text) / 4.0) AS BIGINT) AS input_tokens FROM md),
m AS (SELECT scrape_id, count(*) AS n FROM (SELECT DISTINCT scrape_id, title, href FROM links) GROUP BY 1)
SELECT md5('2024-01-02 03:04:05 ' || url || '#' || page_id) AS run_id, url, md5(html) AS raw_md5, '{MODEL}' AS model, input_tokens, coalesce(n, 0) AS n_listings
FROM pages JOIN k ON k.scrape_id = page_id LEFT JOIN m ON m.scrape_id = page_id""",
    "asked_once": f"""
WITH known AS (SELECT DISTINCT text FROM documents WHERE source IN ('src1', 'src2', 'src3'))
SELECT doc_id, CASE WHEN known.text IS NOT NULL THEN 'stored ' ELSE 'asked ' END || md5(d.text) AS reply,
       CAST(ceil(length({_PROMPT_HEAD} || d.text) / 4.0) AS BIGINT) AS input_tokens FROM documents d LEFT JOIN known ON known.text = d.text""",
    "response_record": f"""
WITH {_LINKS},
j AS (SELECT scrape_id, string_agg('{{"title":"' || title || '","href":"' || href || '"}}', ',' ORDER BY pos) AS body FROM links GROUP BY 1),
r AS (SELECT scrape_id, text, '{{"listings":[' || coalesce(body, '') || ']}}' AS reply FROM md LEFT JOIN j USING (scrape_id)),
k AS (SELECT scrape_id, CAST(ceil(length({_PROMPT_HEAD} || text) / 4.0) AS BIGINT) AS input_tokens,
             CAST(ceil(length(reply) / 4.0) AS BIGINT) AS output_tokens FROM r),
m AS (SELECT scrape_id, title, href, min(pos) AS pos FROM links GROUP BY ALL),
d AS (SELECT scrape_id, count(*) AS n, string_agg('{{"title":"' || title || '","href":"' || href || '","note":""}}', ',' ORDER BY pos) AS body FROM m GROUP BY 1)
SELECT scrape_id, 0 AS part, coalesce(n, 0) AS n_listings, md5('[' || coalesce(body, '') || ']') AS data_md5, input_tokens, output_tokens,
       round(CAST(input_tokens * 0.000000150000 + output_tokens * 0.000000600000 AS DOUBLE), 10) AS cost, '{MODEL}' AS model
FROM k LEFT JOIN d USING (scrape_id)""",
    "parse_listings": f"""
WITH {_REPLY} SELECT scrape_id, chunk_idx, status, CASE WHEN status = 'ok' THEN 2 ELSE 0 END AS n, input_tokens, output_tokens FROM t""",
    "repair_json": f"""
WITH {_REPLY}, {_REPAIR},
g AS (SELECT *, CASE WHEN p_type = 'ECONOMY' THEN '{{"listings":[' || j1 || ',' || j2 || ']}}' WHEN p_type = 'SMALL' THEN '{{"listings":[' || j1 || ']}}' ELSE reply END AS fixed,
       CASE WHEN p_type = 'ECONOMY' THEN '{{"listings":[' || j1 || ']}}' ELSE reply END AS compat FROM f)
SELECT chunk_idx, md5(fixed) AS fixed_md5, CASE WHEN good OR p_type = 'ECONOMY' THEN 2 WHEN p_type = 'SMALL' THEN 1 ELSE 0 END AS n_fixed,
       md5(compat) AS compat_md5, CASE WHEN good THEN 2 WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS n_compat FROM g""",
    "fill_fields": f"""
WITH {_REPLY} SELECT scrape_id, chunk_idx, 0 AS pos, p_name AS product_name, price, CAST(p_size AS VARCHAR) AS rating FROM t WHERE status = 'ok'
UNION ALL SELECT scrape_id, chunk_idx, 1, p_brand, '1', '' FROM t WHERE status = 'ok'""",
    "fill_fields_map": f"""
WITH {_REPLY} SELECT scrape_id, chunk_idx, 0 AS pos, p_name AS product_name, price, CAST(p_size AS VARCHAR) AS rating, NULL AS extra FROM t WHERE status = 'ok'
UNION ALL SELECT scrape_id, chunk_idx, 1, p_brand, '1', '', 'true' FROM t WHERE status = 'ok'""",
    "flatten_listings": f"""
WITH {_REPLY} SELECT scrape_id, chunk_idx, 0 AS pos, p_name AS product_name, price FROM t WHERE NOT failed AND (good OR p_type IN ('ECONOMY', 'SMALL'))
UNION ALL SELECT scrape_id, chunk_idx, 1, p_brand, '1' FROM t WHERE NOT failed AND (good OR p_type = 'ECONOMY')""",
    "merge_listings": """
WITH i AS (SELECT l_suppkey AS scrape_id, l_linenumber AS chunk_idx, l_orderkey AS pos, l_returnflag AS flag, l_linestatus AS state,
                  CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY scrape_id, flag, state, quantity ORDER BY chunk_idx, pos) AS rn FROM i)
SELECT scrape_id, chunk_idx, pos, flag, state, quantity FROM n WHERE rn = 1""",
    "token_totals": f"WITH {_REPLY} SELECT scrape_id, sum(input_tokens) AS input_tokens, sum(output_tokens) AS output_tokens FROM t GROUP BY 1",
    "failed_chunks": f"""
WITH {_REPLY} SELECT scrape_id, chunk_idx, status, CASE WHEN failed THEN 'TimeoutError: no answer' ELSE 'invalid_json' END AS reason
FROM t WHERE status IN ('failed', 'invalid')""",
    "listing_counts": f"""
WITH {_REPLY} SELECT scrape_id, count(*) AS n_chunks, sum(CASE WHEN status IN ('failed', 'invalid') THEN 1 ELSE 0 END) AS n_failed,
       sum(CASE WHEN status = 'ok' THEN 2 ELSE 0 END) AS n_found FROM t GROUP BY 1""",
    "calculate_price": f"""
WITH e AS (SELECT event_id, value, {MODEL_SQL} AS m, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS input_tokens,
                  CAST(floor(value) AS BIGINT) AS output_tokens FROM events WHERE value <= 300)
SELECT event_id, input_tokens, output_tokens, round(CAST(input_tokens * input_rate + output_tokens * output_rate AS DOUBLE), 10) AS cost
FROM e JOIN {PRICING_SQL} ON m = model""",
    "supported_models": """
SELECT 'gpt-0' AS model, 'unsupported_model' AS reason, count(*) AS n_runs FROM events WHERE value > 300 HAVING count(*) > 0""",
    "unwrap_container": """
WITH b AS (SELECT p_partkey, p_type, p_name, '[{"name":"' || p_name || '"}]' AS body FROM part)
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'list' WHEN 'PROMO' THEN 'object' WHEN 'LARGE' THEN 'error' WHEN 'SMALL' THEN 'error' ELSE 'single_key' END AS kind,
       CASE p_type WHEN 'PROMO' THEN '{"a":' || body || ',"b":1}' WHEN 'LARGE' THEN NULL WHEN 'SMALL' THEN NULL ELSE body END AS payload FROM b""",
}
