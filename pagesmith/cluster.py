"""The few places where a job touches cluster-wide settings and shared storage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a private one only in local mode."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="pagesmith-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def reach_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library from where the driver has it, whatever folder they
    start in. On a cluster that doesn't share that folder, install the wheel instead."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def bounded_batches(spark: SparkSession, size: str = "8m") -> SparkSession:
    """Bound the Arrow batches that go to Python workers and come back by bytes, too, not by rows alone:
    ten thousand long texts or whole sets are most of a worker's memory. The session's own setting stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, size)
    return spark


#: Folders of the tables written inside the innermost :func:`settled`.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table in the shared folder and go on from it.

    Later steps read back just the columns they need instead of repeating the work, and a lost
    executor repeats nothing either."""
    folder = f"{shared_folder(df.sparkSession)}/step-{uuid.uuid4().hex}"
    if (passing := _passing.get()) is not None:
        passing.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, written; the tables that it wrote on the way are given up.

    Only the result may be used afterwards: other frames that ``make`` built read tables that are gone.
    They go when the result is complete, so a job that fails or is repeated finds them as long as it needs them."""
    outer, ours = _passing.get(), []
    token = _passing.set(ours)
    try:
        made = make()
        _passing.set(outer)
        kept = cut_lineage(made)
    finally:
        _passing.reset(token)
    spark = kept.sparkSession
    for folder in ours:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return kept


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores for heavy per-row work on a scan with fewer splits than cores (a few small
    files). Large inputs have many splits and pass through untouched, without a shuffle.

    For plain scans only: behind a shuffle, adaptive execution sizes the partitions itself."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def explode_array(rows: DataFrame, kept: Sequence[str | Column], array: Column, item: str,
                  position: str = "position") -> DataFrame:
    """One row per array element with its position, arrays evaluated once.

    A plain ``posexplode`` makes the optimizer add a ``size(array) > 0`` filter below it, which
    evaluates a computed array a second time; the outer form with a filter above does not."""
    out = rows.select(*kept, F.posexplode_outer(array).alias(position, item))
    return out.where(F.col(position).isNotNull())


def salted_lookup(facts: DataFrame, records: DataFrame, key: str, how: str = "left",
                  salts: int = 32) -> DataFrame:
    """Join many fact rows to records that are unique on ``key`` without a hot-key task.

    Fact rows of one key are dealt over ``salts`` sub-keys by their content (they should carry an
    id of their own, since identical rows stay together). Each record is copied only to the
    sub-keys its key really uses, so rare keys are not multiplied and nothing is broadcast."""
    if how not in ("left", "inner"):
        raise ValueError("salted_lookup does left and inner joins")
    salt = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    dealt = facts.withColumn("_salt", salt)
    used = dealt.select(key, "_salt").where(F.col(key).isNotNull()).distinct()
    placed = used.join(records, key)
    return dealt.join(placed, [key, "_salt"], how).drop("_salt")
