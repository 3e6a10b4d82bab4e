"""From page text to merged listings: chunk, prompt, parse, fill, flatten, merge, count.

Rows carry ``scrape_id`` (the run), ``chunk_idx`` and ``pos``, so order survives any shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import bounded_batches, explode_array
from ..functions import replies as R
from ..functions.chunks import CHUNK_OVERLAP, CHUNK_SIZE, chunk_text


def chunk_rows(texts: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """One row per chunk of the ``text`` column; the other columns are kept. Long texts go to Python in
    batches bounded by bytes, too: ten thousand of them are most of a worker's memory."""
    bounded_batches(texts.sparkSession)
    others = [c for c in texts.columns if c != "text"]
    cut = texts.withColumn("_chunks", chunk_text(F.col("text"), size, overlap))
    rows = explode_array(cut, others, F.col("_chunks"), "_chunk", "_at")
    return rows.select(*others, "_chunk.chunk_idx", "_chunk.text")


def build_prompts(chunks: DataFrame, fields: Sequence[str]) -> DataFrame:
    return chunks.withColumn("prompt", R.build_prompt(F.col("text"), fields))


def parse_replies(replies: DataFrame, fields: Sequence[str], repair: bool = False,
                  arrays: Sequence[str] = ()) -> DataFrame:
    """Adds ``status`` and ``listings``. A failed call is ``failed``; broken JSON is ``invalid``
    (after an optional repair); neither contributes listings or tokens."""
    text = R.repair_reply(F.col("reply")) if repair else F.col("reply")
    parsed = replies.withColumn("_parsed", R.parse_reply(text, fields, arrays))
    counted = F.col("status").isin("ok", "no_object")
    return (
        parsed.withColumn(
            "status", F.when(F.col("error").isNotNull(), "failed").otherwise(F.col("_parsed.status"))
        )
        .withColumn("listings", F.col("_parsed.listings"))
        .withColumns(
            {
                c: F.when(counted, F.coalesce(F.col(c), F.lit(0))).otherwise(F.lit(0)).cast("bigint")
                for c in ("input_tokens", "output_tokens")
            }
        )
        .drop("_parsed", "reply")
    )


def failed_chunks(parsed: DataFrame) -> DataFrame:
    """Chunks that gave nothing, with the reason; the other chunks go on regardless."""
    reason = F.coalesce("error", F.when(F.col("status") == "invalid", "invalid_json"))
    return parsed.where(F.col("status").isin("failed", "invalid")).select(
        "scrape_id", "chunk_idx", "status", reason.alias("reason")
    )


def fill_listings(parsed: DataFrame, fields: Sequence[str], arrays: Sequence[str] = ()) -> DataFrame:
    """Requested fields that a record lacks become empty text (or an empty array)."""
    return parsed.withColumn(
        "listings", F.transform("listings", lambda r: R.fill_record(r, fields, arrays))
    )


def flatten_listings(parsed: DataFrame, fields: Sequence[str]) -> DataFrame:
    """All chunks' records as rows, in ``(chunk_idx, pos)`` order."""
    kept = ["scrape_id", "chunk_idx"]
    rows = explode_array(parsed, kept, F.col("listings"), "record", "pos")
    values = [F.col("record").getField(f).alias(f) for f in fields]
    return rows.select("scrape_id", "chunk_idx", "pos", *values)


def merge_listings(listings: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Drop repeated records of a run: equal values in declared field order; the first one stays.

    A plain aggregation, so repeats collapse before the shuffle and a run that holds a third of
    all rows still spreads over all tasks by its values."""
    pack, unpack = _position_codec(listings)
    merged = listings.groupBy("scrape_id", *[_quoted(f) for f in fields]).agg(
        F.min(pack).alias("_first")
    )
    return merged.select("scrape_id", *unpack(F.col("_first")), *[_quoted(f) for f in fields])


def _position_codec(listings: DataFrame):
    """(chunk_idx, pos) as one number, so that its minimum is taken by a hash aggregation; the
    minimum of a struct would sort all rows. Two INT columns fit a BIGINT, others a DECIMAL."""
    kinds = {c: listings.schema[c].dataType for c in ("chunk_idx", "pos")}
    chunk, pos = F.col("chunk_idx"), F.col("pos")
    if all(kind == T.IntegerType() for kind in kinds.values()):
        packed = F.shiftleft(chunk.cast("bigint"), 32).bitwiseOR(pos.cast("bigint"))
        parts = lambda p: (F.shiftright(p, 32), p.bitwiseAND(F.lit(0xFFFFFFFF)))
    else:
        span = F.lit(Decimal(10**19)).cast("decimal(20,0)")
        packed = (chunk.cast("decimal(18,0)") * span + pos.cast("decimal(19,0)")).cast("decimal(38,0)")
        parts = lambda p: ((p - p % span) / span, p % span)

    def unpack(first: Column) -> list[Column]:
        return [v.cast(kinds[c]).alias(c) for c, v in zip(kinds, parts(first))]

    return packed, unpack


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def token_totals(parsed: DataFrame) -> DataFrame:
    """Input and output tokens of each run; missing counts as 0."""
    total = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c)
    return parsed.groupBy("scrape_id").agg(total("input_tokens"), total("output_tokens"))


def run_counts(parsed: DataFrame, by: Sequence[str] = ("scrape_id",)) -> DataFrame:
    """Per run: chunks processed, chunks that failed, records found, tokens used."""
    bad = F.col("status").isin("failed", "invalid").cast("int")
    return parsed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum(bad).alias("n_failed"),
        F.sum(F.size("listings")).alias("n_found"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
    )


def response_parts(merged: DataFrame, fields: Sequence[str], chunks_per_part: int = 64) -> DataFrame:
    """Listings of a run as ordered arrays: one part per block of chunks.

    A small run is a single part. A huge run becomes several rows instead of one endless array."""
    record = F.struct("chunk_idx", "pos", F.struct(*[_quoted(f) for f in fields]).alias("data"))
    part = F.floor(F.col("chunk_idx") / chunks_per_part).cast("int").alias("part")
    grouped = merged.groupBy("scrape_id", part).agg(F.sort_array(F.collect_list(record)).alias("r"))
    return grouped.select("scrape_id", "part", F.col("r.data").alias("data"))
