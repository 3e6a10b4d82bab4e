"""Questions about stored runs: filtered latest-first lists, totals and per-model groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How many runs the list and the totals look back by default.
LIST_LIMIT = 50
TOTALS_LIMIT = 100
# Display names of the history columns.
DISPLAY_NAMES = {
    "id": "ID", "url": "URL", "timestamp": "Timestamp", "model_used": "Model",
    "input_tokens": "Input Tokens", "output_tokens": "Output Tokens", "total_cost": "Total Cost",
}


def retrieve_runs(metadata: DataFrame, token_costs: DataFrame, limit: int | None = LIST_LIMIT,
                  model: str | None = None, start_date: str | None = None,
                  end_date: str | None = None, end_inclusive: bool = False) -> DataFrame:
    """Runs with their token row, newest first. ``end_date`` is a bare day and excludes that whole
    day unless ``end_inclusive``. Filters reach the metadata scan, and on stored tables the dates
    prune the ``run_date`` partitions of both sides; the limit is a distributed top-k."""
    runs = metadata
    if "run_date" in metadata.columns and "run_date" in token_costs.columns:
        runs = _within_dates(runs, start_date, end_date)
        token_costs = _within_dates(token_costs, start_date, end_date)
    if model is not None:
        runs = runs.where(F.col("model_used") == model)
    if start_date is not None:
        runs = runs.where(F.col("timestamp") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date is not None:
        end = F.lit(end_date).cast("timestamp_ntz")
        if end_inclusive:
            end = end + F.expr("INTERVAL 1 DAY")
        runs = runs.where(F.col("timestamp") < end)
    costs = token_costs.select("scrape_id", "input_tokens", "output_tokens", "total_cost")
    joined = runs.join(costs, F.col("id") == F.col("scrape_id")).select(
        "id", "url", "timestamp", "model_used", "input_tokens", "output_tokens", "total_cost"
    )
    if limit is None:
        return joined
    return joined.orderBy(F.desc("timestamp"), F.desc("id")).limit(limit)


def _within_dates(rows: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    day = F.col("run_date")
    if start_date is not None:
        rows = rows.where(day >= F.to_date(F.lit(start_date)))
    if end_date is not None:
        rows = rows.where(day <= F.to_date(F.lit(end_date)))
    return rows


def with_display_names(runs: DataFrame) -> DataFrame:
    return runs.withColumnsRenamed(DISPLAY_NAMES)


def history_totals(runs: DataFrame) -> DataFrame:
    """Total and mean cost, total input and output tokens of the given runs."""
    return runs.agg(
        F.sum("total_cost").cast("double").alias("total_cost"),
        (F.sum("total_cost").cast("double") / F.count("total_cost")).alias("mean_cost"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
    )


def cost_by_model(runs: DataFrame) -> DataFrame:
    return (
        runs.where(F.col("model_used").isNotNull())
        .groupBy("model_used")
        .agg(F.sum("total_cost").cast("double").alias("total_cost"))
        .orderBy("model_used")
    )


def tokens_by_model(runs: DataFrame) -> DataFrame:
    """Both token sums side by side, one row per model (one pass instead of two aligned ones)."""
    return (
        runs.where(F.col("model_used").isNotNull())
        .groupBy("model_used")
        .agg(
            F.sum("input_tokens").alias("input_tokens"),
            F.sum("output_tokens").alias("output_tokens"),
        )
        .orderBy("model_used")
    )


def listings_of_run(listings: DataFrame, scrape_id: int | None = None,
                    schema: T.StructType | None = None) -> DataFrame:
    """Stored JSON records of one run (or of all runs), parsed back; a map when no schema is given."""
    record = schema or T.MapType(T.StringType(), T.StringType())
    rows = listings if scrape_id is None else listings.where(F.col("scrape_id") == scrape_id)
    return rows.select("scrape_id", F.from_json("data", record).alias("record"))


def run_stats(products: DataFrame, group: str = "store") -> DataFrame:
    """Per harvest: products, pages reached and seconds from first to last row."""
    return products.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_products"),
        F.max("page_number").alias("n_pages"),
        F.timestamp_diff("SECOND", F.min("ts"), F.max("ts")).alias("elapsed_seconds"),
    )
