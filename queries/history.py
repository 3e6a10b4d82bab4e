"""Stored runs and questions about them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pagesmith.cluster import shared_folder
from pagesmith.operators import history as H
from pagesmith.operators import runs as R
from pagesmith.operators.pricing import pricing_table as prices

from .common import MODEL_SQL, PRICING_SQL, RUNS_SQL, model_of_event, run_tables, second_text, table


def _show(runs):
    return runs.select(
        "id", "url", second_text(F.col("timestamp")).alias("timestamp"), "model_used", "input_tokens",
        "output_tokens", F.round(F.col("total_cost").cast("double"), 10).alias("total_cost"),
    )


def _round(rows, *names):
    return rows.withColumns({n: F.round(n, 10) for n in names})


def store_run(spark, sf):
    """Two batches with runs of the same days, the first of them stored again; all are read back."""
    folder = f"{shared_folder(spark)}/runs-{uuid.uuid4().hex}"
    metadata, listings, costs = run_tables(spark, sf)
    day = metadata.select(F.col("id").alias("scrape_id"), F.to_date("timestamp").alias("run_date"))
    dated = [metadata.withColumn("run_date", F.to_date("timestamp"))]
    dated += [rows.join(day, "scrape_id") for rows in (listings, costs)]
    ids = ("id", "scrape_id", "scrape_id")
    for batch, rest in (("odd", 1), ("even", 0), ("odd", 1)):
        R.store_runs(folder, batch, *[rows.where(F.col(i) % 2 == rest) for rows, i in zip(dated, ids, strict=True)])
    stored, stored_listings, stored_costs = R.read_runs(spark, folder)
    counts = [
        stored.groupBy("run_date").agg(F.count(F.lit(1)).alias("n_runs")),
        stored_listings.groupBy("run_date").agg(F.count(F.lit(1)).alias("n_listings")),
        stored_costs.groupBy("run_date").agg(F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens")),
    ]
    joined = counts[0].join(counts[1], "run_date", "left").join(counts[2], "run_date", "left")
    return joined.withColumn("run_date", F.col("run_date").cast("string"))


def orphan_check(spark, sf):
    metadata, listings, _ = run_tables(spark, sf)
    return R.orphans(listings, metadata.where(F.col("model_used") != "Llama3.1 8B"))


def retrieve_scrapes(spark, sf):
    metadata, _, costs = run_tables(spark, sf)
    return _show(H.retrieve_runs(metadata, costs, 50, "gpt-4o-mini", "2024-01-05", "2024-01-20"))


def retrieve_scrapes_all(spark, sf):
    metadata, _, costs = run_tables(spark, sf)
    return _show(H.retrieve_runs(metadata, costs, None, None, "2024-01-05", "2024-01-20", end_inclusive=True))


def listings_for_scrape(spark, sf):
    """Records of every run parsed back from JSON."""
    _, listings, _ = run_tables(spark, sf)
    rows = H.listings_of_run(listings)
    return rows.select("scrape_id", *[F.try_element_at("record", F.lit(k)).alias(k) for k in ("event_type", "value")])


def history_totals(spark, sf):
    metadata, _, costs = run_tables(spark, sf)
    return _round(H.history_totals(H.retrieve_runs(metadata, costs, H.TOTALS_LIMIT)), "total_cost", "mean_cost")


def history_totals_all(spark, sf):
    metadata, _, costs = run_tables(spark, sf)
    return _round(H.history_totals(H.retrieve_runs(metadata, costs, None)), "total_cost", "mean_cost")


def cost_by_model(spark, sf):
    metadata, _, costs = run_tables(spark, sf)
    return _round(H.cost_by_model(H.retrieve_runs(metadata, costs, None)), "total_cost")


def tokens_by_model(spark, sf):
    metadata, _, costs = run_tables(spark, sf)
    return H.tokens_by_model(H.retrieve_runs(metadata, costs, None))


def run_stats(spark, sf):
    products = table(spark, sf, "events").select(
        F.col("user_id").alias("store"), F.get_json_object("props", "$.k").cast("int").alias("page_number"), "ts"
    )
    return H.run_stats(products)


def display_labels(spark, sf):
    metadata, _, costs = run_tables(spark, sf)
    shown = H.with_display_names(_show(H.retrieve_runs(metadata, costs, None)))
    return shown.select("ID", "Model", "Input Tokens", "Total Cost")


def pricing_table(spark, sf):
    """The price list with the number of stored runs per model."""
    runs = table(spark, sf, "events").groupBy(model_of_event().alias("model")).agg(F.count(F.lit(1)).alias("n_runs"))
    rate = lambda c: F.col(c).cast("double").alias(c)
    return prices(spark).join(runs, "model", "left").select("model", rate("input_rate"), rate("output_rate"), "n_runs")


QUERIES = {
    f.__name__: f
    for f in (
        store_run, orphan_check, retrieve_scrapes, retrieve_scrapes_all, listings_for_scrape, history_totals,
        history_totals_all, cost_by_model, tokens_by_model, run_stats, display_labels, pricing_table,
    )
}

_SHOW = """id, url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, model_used, input_tokens, output_tokens,
       round(CAST(total_cost AS DOUBLE), 10) AS total_cost"""
_TOTALS = """round(CAST(sum(total_cost) AS DOUBLE), 10) AS total_cost, round(CAST(sum(total_cost) AS DOUBLE) / count(*), 10) AS mean_cost,
       sum(input_tokens) AS input_tokens, sum(output_tokens) AS output_tokens"""
ORACLE = {
    "store_run": """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_date, count(*) AS n_runs, count(*) AS n_listings,
       sum(CASE WHEN value >= 1 THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END) AS input_tokens,
       sum(CASE WHEN value >= 1 THEN CAST(floor(value) AS BIGINT) END) AS output_tokens FROM events GROUP BY 1""",
    "orphan_check": "SELECT event_id AS scrape_id, 1 AS n_rows FROM events WHERE event_type = 'error'",
    "retrieve_scrapes": f"""
WITH {RUNS_SQL} SELECT {_SHOW} FROM priced WHERE model_used = 'gpt-4o-mini' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'
ORDER BY ts DESC, id DESC LIMIT 50""",
    "retrieve_scrapes_all": f"""
WITH {RUNS_SQL} SELECT {_SHOW} FROM priced WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'""",
    "listings_for_scrape": """
SELECT event_id AS scrape_id, event_type, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS value FROM events""",
    "history_totals": f"""
WITH {RUNS_SQL} SELECT {_TOTALS} FROM (SELECT * FROM priced ORDER BY ts DESC, id DESC LIMIT 100)""",
    "history_totals_all": f"WITH {RUNS_SQL} SELECT {_TOTALS} FROM priced",
    "cost_by_model": f"""
WITH {RUNS_SQL} SELECT model_used, round(CAST(sum(total_cost) AS DOUBLE), 10) AS total_cost FROM priced GROUP BY 1""",
    "tokens_by_model": f"""
WITH {RUNS_SQL} SELECT model_used, sum(input_tokens) AS input_tokens, sum(output_tokens) AS output_tokens FROM priced GROUP BY 1""",
    "run_stats": """
SELECT user_id AS store, count(*) AS n_products, max(CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)) AS n_pages,
       date_sub('second', min(ts), max(ts)) AS elapsed_seconds FROM events GROUP BY 1""",
    "display_labels": f"""
WITH {RUNS_SQL} SELECT id AS "ID", model_used AS "Model", input_tokens AS "Input Tokens",
       round(CAST(total_cost AS DOUBLE), 10) AS "Total Cost" FROM priced""",
    "pricing_table": f"""
WITH n AS (SELECT {MODEL_SQL} AS m, count(*) AS n_runs FROM events GROUP BY 1)
SELECT model, CAST(input_rate AS DOUBLE) AS input_rate, CAST(output_rate AS DOUBLE) AS output_rate, n_runs
FROM {PRICING_SQL} LEFT JOIN n ON m = model""",
}
