"""Stored runs: three partitioned Parquet tables plus the export formats."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import clean_batches, compact_batches, read_table, remove_batch, snapshot, store_batch

TABLES = ("scrape_metadata", "listings", "token_costs")
SORT_KEYS = {"scrape_metadata": "id", "listings": "scrape_id", "token_costs": "scrape_id"}


def run_id(url: Column, started_at: Column) -> Column:
    """Deterministic id of a run: no counter to share between tasks, same id on a repeated batch,
    and wide enough (128 bits) that two runs never share one."""
    return F.md5(F.concat_ws(" ", started_at.cast("string"), url))


def listing_records(merged: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Merged listings -> ``scrape_id, seq, data`` rows with the record as JSON text."""
    record = F.struct(*[F.col(f"`{f}`") for f in fields])
    return merged.select(
        "scrape_id", F.struct("chunk_idx", "pos").alias("seq"), F.to_json(record).alias("data")
    )


def store_runs(folder: str, batch_id: str, metadata: DataFrame, listings: DataFrame,
               token_costs: DataFrame) -> None:
    """Store a batch of runs in three tables below ``folder``, partitioned by ``run_date``.

    Other batches are never touched, also not those of the same day; a batch that is repeated, even
    with fewer rows, replaces just itself. All three tables of a batch become visible at once: a job
    that fails or is killed on the way leaves everything as it was."""
    batch = dict(zip(TABLES, (metadata, listings, token_costs), strict=True))
    store_batch(metadata.sparkSession, folder, batch_id, batch, SORT_KEYS)


def read_runs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(metadata, listings, token_costs) of the batches stored by :func:`store_runs`, all of one moment."""
    seen = snapshot(spark, folder)
    return tuple(read_table(spark, seen, name).drop("batch_id") for name in TABLES)


def remove_runs(spark: SparkSession, folder: str, batch_id: str) -> None:
    """The batch is not seen any more."""
    remove_batch(spark, folder, batch_id)


def compact_runs(spark: SparkSession, folder: str, small_bytes: int = 128 << 20) -> int:
    """Bring small batches together, so that the number of files follows the days, not the batches."""
    return compact_batches(spark, folder, SORT_KEYS, small_bytes)


def clean_runs(spark: SparkSession, folder: str, older_than: float = 86_400) -> int:
    """Remove files that no batch needs, older than so many seconds."""
    return clean_batches(spark, folder, list(TABLES), older_than)


def orphans(children: DataFrame, metadata: DataFrame) -> DataFrame:
    """Run ids used by child rows that no metadata row has, with their row count.

    Children are counted per run before the anti-join, so a huge run is one row in it."""
    per_run = children.groupBy("scrape_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return per_run.join(metadata.select(F.col("id").alias("scrape_id")), "scrape_id", "left_anti")


# --- export formats ----------------------------------------------------------------------------


def write_csv(rows: DataFrame, folder: str) -> None:
    """CSV with a header row and no index column; quotes are doubled, line breaks are quoted."""
    rows.write.mode("overwrite").options(header=True, escape='"', quoteAll=True).csv(folder)


def read_csv(spark: SparkSession, folder: str, schema) -> DataFrame:
    options = {"header": True, "escape": '"', "multiLine": True}
    return spark.read.options(**options).schema(schema).csv(folder)


def write_json(rows: DataFrame, folder: str) -> None:
    """JSON records, one per line; nested columns stay nested, non-ASCII text is kept."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(folder)


def write_by_key(rows: DataFrame, folder: str, key: str, fmt: str = "csv", files_per_key: int = 8,
                 rows_per_file: int = 1_000_000) -> None:
    """One folder per key value (a page number, a state name, a run).

    Rows of a key are dealt over several tasks, so the largest key is not one task's work."""
    deal = F.pmod(F.xxhash64(*rows.columns), F.lit(files_per_key))
    writer = (
        rows.repartition(F.col(key), deal)
        .write.mode("overwrite")
        .partitionBy(key)
        .option("maxRecordsPerFile", rows_per_file)
    )
    if fmt == "csv":
        writer.options(header=True, escape='"', quoteAll=True).csv(folder)
    else:
        writer.format(fmt).save(folder)


def _text_files(folder: str):
    """Writes each row's text and a line end as a file of its own, named by task and place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, base = fs.FileSystem.from_uri(folder)
        part, attempt, written = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                name = f"part-{part:05d}-{written:09d}.txt"
                # a file is seen whole or not at all: hidden names are skipped by readers
                hidden = f"{base}/.{name}.{attempt}"
                with place.open_output_stream(hidden) as out:
                    out.write(b"\n" if text is None else text.encode() + b"\n")
                place.move(hidden, f"{base}/{name}")
                written += 1
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], ["files"])

    return run


def write_texts(texts: DataFrame, folder: str) -> None:
    """One text file per row of the ``text`` column: the text (none if null) and a line end, like the
    text writer of Spark with one record a file, but without its commit of every file.

    Rows are dealt by their text and sorted in each task, so a repeated task writes the same files under
    the same names again; the folder is emptied first."""
    place, base = fs.FileSystem.from_uri(folder)
    place.create_dir(base, recursive=True)
    place.delete_dir_contents(base)
    text = F.col("text")
    rows = texts.select(text).repartition(F.xxhash64(text)).sortWithinPartitions(F.xxhash64(text), text)
    rows.mapInArrow(_text_files(folder), "files long").agg(F.sum("files")).collect()
