"""Tables stored in batches: all tables of a batch become visible at once, or not at all.

Below a folder lie ``<table>/commit=<id>/run_date=<day>/*.parquet`` and ``manifests/<id>.json``. A commit's
files are written first; its manifest, written last under a hidden name and renamed once, makes it count. It
says which batches the commit holds, each with a stamp. A batch belongs to the commit with its newest stamp,
so a batch that is stored again replaces just itself, also where it lies in a commit with others. Readers
take one look at the manifests and never see files of a job that ended before its manifest.

Nothing that a reader may be using is touched until :func:`clean_batches` removes what no batch belongs to."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "commit string, generation int, batches map<string, bigint>, schemas map<string, string>"


@dataclass(frozen=True)
class Snapshot:
    """What is stored at one moment: the manifests, and the commit that each batch belongs to."""

    folder: str
    commits: dict[str, Row]
    owner: dict[str, str]

    def owned(self, commit: str) -> set[str]:
        return {batch for batch, by in self.owner.items() if by == commit}

    def live(self) -> list[str]:
        """Commits with files that some batch belongs to."""
        return [c for c in sorted(set(self.owner.values())) if self.commits[c].schemas]


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def snapshot(spark: SparkSession, folder: str) -> Snapshot:
    fs, path = _path(spark, f"{folder}/manifests")
    found = spark.read.schema(MANIFEST).json(f"{folder}/manifests").collect() if fs.exists(path) else []
    owner: dict[str, str] = {}
    stamps: dict[str, int] = {}
    # of equal stamps, a compaction's copy holds the same rows
    for manifest in sorted(found, key=lambda m: (m.generation, m.commit)):
        for batch, stamp in manifest.batches.items():
            if stamp >= stamps.get(batch, stamp):
                owner[batch], stamps[batch] = manifest.commit, stamp
    return Snapshot(folder, {m.commit: m for m in found}, owner)


def _publish(spark: SparkSession, folder: str, commit: str, batches: Mapping[str, int],
             schemas: Mapping[str, str], generation: int = 0) -> None:
    manifest = {"commit": commit, "generation": generation, "batches": dict(batches), "schemas": dict(schemas)}
    fs, hidden = _path(spark, f"{folder}/manifests/_{commit}")
    out = fs.create(hidden, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if not fs.rename(hidden, _path(spark, f"{folder}/manifests/{commit}.json")[1]):
        raise OSError(f"the manifest of commit {commit} could not be renamed")


def _write(folder: str, commit: str, tables: Mapping[str, DataFrame], sort_keys: Mapping[str, str]) -> dict[str, str]:
    """Writes the tables side by side; returns their schemas. The rows of a date are dealt by what they hold
    over as many tasks as their bytes need and sorted by key, so a lookup by key skips most row groups."""

    def one(name: str) -> tuple[str, str]:
        rows = tables[name]
        dealt = rows.hint("rebalance", "run_date").sortWithinPartitions("run_date", sort_keys[name])
        dealt.write.partitionBy("run_date").parquet(f"{folder}/{name}/commit={commit}")
        return name, rows.schema.json()

    with ThreadPoolExecutor(len(tables)) as pool:
        return dict(pool.map(one, tables))


def _stamp(seen: Snapshot, batch_id: str) -> int:
    before = seen.commits[seen.owner[batch_id]].batches[batch_id] if batch_id in seen.owner else 0
    return max(time.time_ns() // 1_000_000, before + 1)


def _checked(batch_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
        raise ValueError("a batch id has letters, digits, '.', '_' and '-' only")
    return batch_id


def store_batch(spark: SparkSession, folder: str, batch_id: str, tables: Mapping[str, DataFrame],
                sort_keys: Mapping[str, str]) -> None:
    """Store a batch's tables, each with a ``run_date``, in place of what was stored for it before. If any of
    them fails, everything stays as it was."""
    commit = uuid.uuid4().hex
    marked = {name: rows.withColumn("batch_id", F.lit(_checked(batch_id))) for name, rows in tables.items()}
    schemas = _write(folder, commit, marked, sort_keys)
    _publish(spark, folder, commit, {batch_id: _stamp(snapshot(spark, folder), batch_id)}, schemas)


def remove_batch(spark: SparkSession, folder: str, batch_id: str) -> None:
    """From here on the batch is not seen any more: its newest commit has no files."""
    stamp = _stamp(snapshot(spark, folder), _checked(batch_id))
    _publish(spark, folder, uuid.uuid4().hex, {batch_id: stamp}, {})


def read_table(spark: SparkSession, seen: Snapshot, name: str, commits: list[str] | None = None) -> DataFrame:
    """All rows of a table as they stood at the snapshot, with their ``batch_id``."""
    commits = seen.live() if commits is None else commits
    if not commits:
        raise ValueError(f"no batch is stored in {seen.folder}")
    newest = max(commits, key=lambda c: max(seen.commits[c].batches.values()))
    schema = T.StructType.fromJson(json.loads(seen.commits[newest].schemas[name]))
    base = f"{seen.folder}/{name}"
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField("commit", T.StringType())]))
    rows = reader.option("basePath", base).parquet(*[f"{base}/commit={c}" for c in commits])
    replaced = {c: sorted(set(seen.commits[c].batches) - seen.owned(c)) for c in commits}
    stale: list[Column] = [(F.col("commit") == c) & F.col("batch_id").isin(b) for c, b in replaced.items() if b]
    if stale:
        rows = rows.where(~reduce(Column.__or__, stale))
    return rows.drop("commit")


def compact_batches(spark: SparkSession, folder: str, sort_keys: Mapping[str, str], small_bytes: int = 128 << 20) -> int:
    """Bring the batches of all commits smaller than that together in one commit, and return how many those were.

    Readers see the same rows before and after. A batch that is stored or removed meanwhile has a newer stamp
    than the copy made of it here, so that copy doesn't count. Run one compaction of a folder at a time."""
    seen = snapshot(spark, folder)

    def size(commit: str) -> int:
        places = [_path(spark, f"{folder}/{name}/commit={commit}") for name in sort_keys]
        return sum(fs.getContentSummary(path).getLength() for fs, path in places)

    small = [c for c in seen.live() if size(c) < small_bytes]
    if len(small) < 2:
        return 0
    commit = uuid.uuid4().hex
    schemas = _write(folder, commit, {n: read_table(spark, seen, n, small) for n in sort_keys}, sort_keys)
    batches = {b: seen.commits[c].batches[b] for c in small for b in seen.owned(c)}
    _publish(spark, folder, commit, batches, schemas, 1 + max(seen.commits[c].generation for c in small))
    return len(small)


def clean_batches(spark: SparkSession, folder: str, names: list[str], older_than: float = 86_400) -> int:
    """Remove commits that no batch belongs to, and files of jobs that ended before their manifest, if they are
    older than so many seconds: longer than any job that may still write or read them. Returns how many went."""
    seen = snapshot(spark, folder)
    kept = set(seen.live())
    named = [b for c, m in seen.commits.items() if m.schemas for b in m.batches]
    kept |= {c for c, m in seen.commits.items() if not m.schemas and any(b in named and seen.owner[b] == c for b in m.batches)}
    latest, gone = (time.time() - older_than) * 1000, set()
    for name in [*names, "manifests"]:  # files before manifests, so that what is left half-done is found again
        fs, path = _path(spark, f"{folder}/{name}")
        for status in fs.listStatus(path) if fs.exists(path) else ():
            commit = status.getPath().getName().removeprefix("commit=").removeprefix("_").removesuffix(".json")
            if re.fullmatch(r"[0-9a-f]{32}", commit) and commit not in kept and status.getModificationTime() <= latest:
                fs.delete(status.getPath(), True)
                gone.add(commit)
    return len(gone)
