"""Entry relations: tables or folders of already fetched pages and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table of fetched pages: ``page_id, url, html`` and optionally ``status``."""
    return spark.read.parquet(path)


def split_by_status(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): no response, or an HTTP status of 400 and above, is an error."""
    if "status" not in pages.columns:
        failed = F.col("html").isNull()
        reason = F.lit("no_response")
    else:
        failed = F.col("html").isNull() | F.coalesce(F.col("status") >= 400, F.lit(True))
        reason = F.when(
            F.col("html").isNull() | F.col("status").isNull(), "no_response"
        ).otherwise(F.concat(F.lit("http_"), F.col("status").cast("string")))
    return pages.where(~failed), pages.where(failed).withColumn("reason", reason)


def _scan_whole_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    return (
        spark.read.text(folder, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def scan_html_dir(spark: SparkSession, folder: str, glob: str = "*.html") -> DataFrame:
    """Saved pages, one document per file; files with other names are skipped."""
    return _scan_whole_files(spark, folder, glob).withColumnRenamed("text", "html")


def scan_text_dir(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """One text file = one document."""
    return _scan_whole_files(spark, folder, glob)
