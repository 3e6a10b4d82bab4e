"""The extraction job over newly arriving page files.

The reference behaviour is batch; page files that keep arriving are handled by the very same batch
job, one micro-batch at a time, and stored idempotently by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.runs import listing_records
from ..plans.extract import extract_pages


def read_arrivals(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    schema = "page_id bigint, url string, html string"
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def extract_arrivals(arrivals: DataFrame, out: str, checkpoint: str, fields: Sequence[str],
                     model: str, pricing: DataFrame):
    """Start a query that writes each micro-batch's listings below ``out/batch=<id>``; a batch that
    is retried replaces its own folder, so every page counts once."""

    def store(batch: DataFrame, batch_id: int) -> None:
        result = extract_pages(batch, fields, model, pricing)
        rows = listing_records(result.listings, fields)
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        arrivals.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
