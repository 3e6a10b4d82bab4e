"""Export formats: every query writes a whole table and returns what is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pagesmith.cluster import shared_folder, spread
from pagesmith.functions.html import to_markdown
from pagesmith.functions.replies import unwrap_container
from pagesmith.operators import runs as R

from .common import deal_rows, sql_markdown, table


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def sink_csv(spark, sf):
    """Texts with quotes, commas and line breaks survive."""
    docs = table(spark, sf, "documents").select("doc_id", F.concat(F.lit('"a, '), "text").alias("text"))
    folder = _folder(spark, "csv")
    R.write_csv(docs, folder)
    back = R.read_csv(spark, folder, "doc_id bigint, text string")
    return back.select("doc_id", F.md5("text").alias("text_md5"))


def sink_json(spark, sf):
    rows = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.struct(F.concat(F.lit("é "), "s_name").alias("name"), F.when(F.col("s_acctbal") > 0, F.col("s_nationkey")).alias("nation")).alias("who"),
    )
    folder = _folder(spark, "json")
    R.write_json(rows, folder)
    back = spark.read.schema("id bigint, who struct<name: string, nation: int>").json(folder)
    return back.select("id", "who.name", "who.nation")


def sink_sheet_pages(spark, sf):
    """One folder per result page."""
    rows = table(spark, sf, "part").select("p_partkey", "p_name", F.col("p_size").alias("page_number"))
    folder = _folder(spark, "sheets")
    R.write_by_key(rows, folder, "page_number", "parquet", files_per_key=2)
    return spark.read.parquet(folder)


def sink_file_per_key(spark, sf):
    """One CSV folder per state."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", F.concat(F.lit("State "), "c_nationkey").alias("state"))
    folder = _folder(spark, "states")
    R.write_by_key(rows, folder, "state", files_per_key=2)
    schema = "c_custkey bigint, c_name string, state string"
    return R.read_csv(spark, folder, schema)


def sink_markdown(spark, sf):
    """Markdown text of every page as its own file, keyed by run."""
    pages = spread(table(spark, sf, "pages").select("page_id", "html"))
    folder = _folder(spark, "markdown")
    R.write_texts(pages.select(to_markdown(F.col("html")).alias("text")), folder)
    return spark.read.text(folder, wholetext=True).select(F.md5("value").alias("text_md5"), F.length("value").alias("n_chars"))


def sink_extracted(spark, sf):
    """Container JSON -> unwrapped records -> flat table; the container itself is kept as text."""
    listing = F.struct(*[F.coalesce(F.col(c), F.lit("N/A")).alias(c) for c in ("product_name", "current_price", "discount")])
    rows = deal_rows(spark, sf).select("p_partkey", F.to_json(F.struct(F.array(listing).alias("listings"))).alias("reply"))
    folder = _folder(spark, "extracted")
    rows.write.mode("overwrite").parquet(f"{folder}/container")
    kept = spark.read.parquet(f"{folder}/container")
    schema = "array<struct<product_name: string, current_price: string, discount: string>>"
    records = F.from_json(unwrap_container(F.col("reply"))["payload"], schema)
    flat = kept.select("p_partkey", F.inline(records))
    R.write_csv(flat, f"{folder}/table")
    return R.read_csv(spark, f"{folder}/table", flat.schema)


QUERIES = {
    f.__name__: f
    for f in (sink_csv, sink_json, sink_sheet_pages, sink_file_per_key, sink_markdown, sink_extracted)
}

ORACLE = {
    "sink_csv": "SELECT doc_id, md5('\"a, ' || text) AS text_md5 FROM documents",
    "sink_json": "SELECT s_suppkey AS id, 'é ' || s_name AS name, CASE WHEN s_acctbal > 0 THEN s_nationkey END AS nation FROM supplier",
    "sink_sheet_pages": "SELECT p_partkey, p_name, p_size AS page_number FROM part",
    "sink_file_per_key": "SELECT c_custkey, c_name, 'State ' || c_nationkey AS state FROM customer",
    "sink_markdown": f"""
WITH m AS (SELECT {sql_markdown('html')} || chr(10) AS t FROM pages) SELECT md5(t) AS text_md5, length(t) AS n_chars FROM m""",
    "sink_extracted": """
SELECT p_partkey, p_name || ' & ' || p_type AS product_name,
       CASE WHEN p_brand = 'Brand#3' THEN 'call us' ELSE '₹' || format('{:,.2f}', p_retailprice) END AS current_price,
       CASE WHEN p_size >= 10 THEN p_size || '% off' ELSE 'N/A' END AS discount FROM part""",
}
