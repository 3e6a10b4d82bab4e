"""Maintenance of a keyed table: look up, append with next ids, update, delete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import cut_lineage, salted_lookup



def lookup(requests: DataFrame, items: DataFrame, key: str = "id") -> DataFrame:
    """Each request with its item and a ``found`` flag; an unknown id gives ``found = false``."""
    marked = items.withColumn("_hit", F.lit(True))
    out = salted_lookup(requests, marked, key)
    return out.withColumn("found", F.col("_hit").isNotNull()).drop("_hit")


def consecutive_numbers(rows: DataFrame, order: str, name: str = "number") -> DataFrame:
    """Number rows 1..n by a unique column without one global sort task.

    Rows are dealt into ranges of the order column, whatever its values (dense, sparse or hashed);
    only the ranges' counts are summed up in order, then every range numbers its own rows. The ranges
    are written down, so that all steps see the same ones."""
    dealt = rows.repartitionByRange(order)
    blocked = cut_lineage(dealt.withColumn("_block", F.spark_partition_id().cast("bigint")))
    counts = blocked.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_block").orderBy(order)
    return (
        blocked.join(offsets, "_block")
        .withColumn(name, F.col("_offset") + F.row_number().over(inside))
        .drop("_block", "_offset")
    )


def append(items: DataFrame, incoming: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """(new rows, rejects): ids go on from the last one (1 in an empty table); name is required."""
    named = F.col("name").isNotNull() & (F.col("name") != "")
    numbered = consecutive_numbers(incoming.where(named), order, "_number")
    last = items.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    columns = [c for c in items.columns if c != "id"]
    return (
        numbered.select((last + F.col("_number")).alias("id"), *columns),
        incoming.where(~F.coalesce(named, F.lit(False))).withColumn("reason", F.lit("name_required")),
    )


def update(items: DataFrame, changes: DataFrame, columns: Sequence[str],
           order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(items after the update, rejected changes): given values replace, NULLs keep the old value.

    Of several changes of an id, each column takes the last value given, by the ``order`` column;
    without one, the largest. So an item stays one row."""
    given = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))) if order else F.max(c)
    renamed = changes.groupBy("id").agg(*[given(c).alias(f"_new_{c}") for c in columns])
    new: dict[str, Column] = {c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in columns}
    updated = items.join(renamed, "id", "left").withColumns(new)
    unknown = changes.join(items.select("id"), "id", "left_anti")
    return updated.drop(*[f"_new_{c}" for c in columns]), unknown.withColumn(
        "reason", F.lit("unknown_id")
    )


def delete(items: DataFrame, ids: DataFrame) -> DataFrame:
    """Items whose id is not listed; listing an absent id is no error. Repeated ids collapse first."""
    return items.join(ids.select("id").distinct(), "id", "left_anti")
