"""Model prices, cost of a run, and the check that a model is known."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRICING_SCHEMA = "model string, input_rate decimal(18,12), output_rate decimal(18,12)"
# A price list is joined by broadcast, so its size is checked where it is made.
MAX_MODELS = 10_000
# US dollars per million tokens, input and output.
PRICES_PER_MILLION = (
    ("gpt-4o-mini", "0.150", "0.600"),
    ("gpt-4o-2024-08-06", "2.5", "10"),
    ("gemini-1.5-flash", "0.075", "0.30"),
    ("Llama3.1 8B", "0", "0"),
    ("Groq Llama3.1 70b", "0", "0"),
    ("whisper-large-v3", "0.150", "0.600"),
    ("chatgpt", "0.150", "0.600"),
)


def pricing_table(spark: SparkSession,
                  prices: Iterable[tuple[str, str, str]] = PRICES_PER_MILLION) -> DataFrame:
    """One row per model with its per-token rates."""
    million = Decimal(1_000_000)
    rows = {m: (m, Decimal(i) / million, Decimal(o) / million) for m, i, o in prices}
    if len(rows) > MAX_MODELS:
        raise ValueError(f"a price list holds at most {MAX_MODELS} models")
    return spark.createDataFrame(list(rows.values()), PRICING_SCHEMA)


def cost_expr(input_tokens: Column, output_tokens: Column) -> Column:
    """Exact decimal cost; summing it does not depend on row order."""
    tokens = lambda c: F.coalesce(c, F.lit(0)).cast("decimal(15,0)")
    return (
        tokens(input_tokens) * F.col("input_rate") + tokens(output_tokens) * F.col("output_rate")
    ).cast("decimal(38,12)")


def price_runs(runs: DataFrame, pricing: DataFrame, model: str = "model") -> tuple[DataFrame, DataFrame]:
    """(priced runs, runs with an unknown model); ``cost`` is DECIMAL(38,12)."""
    rates = F.broadcast(pricing.withColumnRenamed("model", "_priced_model"))
    joined = runs.join(rates, F.col(model) == F.col("_priced_model"), "left")
    extra = ["_priced_model", "input_rate", "output_rate"]
    cost = cost_expr(F.col("input_tokens"), F.col("output_tokens"))
    good = joined.where(F.col("_priced_model").isNotNull()).withColumn("cost", cost)
    bad = joined.where(F.col("_priced_model").isNull())
    return good.drop(*extra), bad.drop(*extra).withColumn("reason", F.lit("unsupported_model"))
