"""Stored batches: visible at once or not at all, replaced, removed, compacted, cleaned."""

import hashlib
import math
import pathlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from pagesmith.operators import batches, runs, vectors


def _tables(spark, ids, note="a", date="2024-01-01"):
    rows = spark.createDataFrame([(str(i), date, note) for i in ids], "id string, run_date string, note string")
    rows = rows.withColumn("run_date", F.to_date("run_date"))
    child = rows.withColumnRenamed("id", "scrape_id")
    return rows, child, child


def _stored(spark, folder):
    tables = runs.read_runs(spark, str(folder))
    seen = [sorted((r[0], r.note, str(r.run_date)) for r in t.select(t.columns[0], "note", "run_date").collect()) for t in tables]
    assert seen[0] == seen[1] == seen[2]
    return seen[0]


def test_a_failed_batch_is_not_seen(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(ValueError, match="no batch"):
        runs.read_runs(spark, folder)
    with pytest.raises(ValueError, match="batch id"):
        runs.store_runs(folder, "a/b", *_tables(spark, [1]))
    runs.store_runs(folder, "a", *_tables(spark, [1, 2]))
    for broken in range(3):
        for batch in ("a", "b"):
            tables = list(_tables(spark, [7], "new"))
            tables[broken] = tables[broken].withColumn("note", F.raise_error(F.lit("lost")).cast("string"))
            with pytest.raises(Exception, match="lost"):
                runs.store_runs(folder, batch, *tables)
            assert _stored(spark, folder) == [("1", "a", "2024-01-01"), ("2", "a", "2024-01-01")]
    assert runs.clean_runs(spark, folder) == 0  # too young: a job may still be writing them
    assert runs.clean_runs(spark, folder, older_than=-60) == 6
    assert _stored(spark, folder) == [("1", "a", "2024-01-01"), ("2", "a", "2024-01-01")]


def test_manifest_decides_alone(spark, tmp_path, monkeypatch):
    """A job killed after its last table and before its manifest."""
    folder = str(tmp_path)
    runs.store_runs(folder, "a", *_tables(spark, [1]))
    with monkeypatch.context() as m:
        m.setattr(batches, "_publish", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            runs.store_runs(folder, "a", *_tables(spark, [2]))
    assert _stored(spark, folder) == [("1", "a", "2024-01-01")]


def test_batches_are_compacted_replaced_and_removed(spark, tmp_path):
    folder = str(tmp_path)
    for i in range(4):
        runs.store_runs(folder, f"b{i}", *_tables(spark, [2 * i, 2 * i + 1]))
    runs.store_runs(folder, "empty", *_tables(spark, []))
    before = _stored(spark, folder)
    old = runs.read_runs(spark, folder)[0]
    assert runs.compact_runs(spark, folder, small_bytes=0) == 0
    assert runs.compact_runs(spark, folder) == 5 and len(batches.snapshot(spark, folder).live()) == 1
    assert _stored(spark, folder) == before and old.count() == 8
    runs.store_runs(folder, "b1", *_tables(spark, [3], "again", "2024-01-02"))
    expected = sorted([r for r in before if r[0] not in "23"] + [("3", "again", "2024-01-02")])
    assert _stored(spark, folder) == expected
    runs.remove_runs(spark, folder, "b2")
    expected = [r for r in expected if r[0] not in "45"]
    assert _stored(spark, folder) == expected
    assert runs.clean_runs(spark, folder, older_than=-60) == 5
    assert _stored(spark, folder) == expected  # the removal still holds, as the batch's rows lie among others
    assert runs.compact_runs(spark, folder) == 2
    assert _stored(spark, folder) == expected
    # the removal goes last, when nothing is left that holds the batch
    assert [runs.clean_runs(spark, folder, older_than=-60) for _ in range(3)] == [2, 1, 0]
    assert _stored(spark, folder) == expected and len(list(pathlib.Path(folder).glob("manifests/*.json"))) == 1
    assert len(list(pathlib.Path(folder).glob("listings/commit=*/run_date=*/*.parquet"))) == 2
    runs.store_runs(folder, "b2", *_tables(spark, [4]))
    assert _stored(spark, folder) == sorted([*expected, ("4", "a", "2024-01-01")])


def test_a_batch_stored_while_others_are_compacted(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    for batch, i in (("a", 1), ("b", 2)):
        runs.store_runs(folder, batch, *_tables(spark, [i]))
    publish = batches._publish

    def late(*args):
        if args[-1] == 1:  # a compaction's generation
            runs.store_runs(folder, "a", *_tables(spark, [9]))
        publish(*args)

    monkeypatch.setattr(batches, "_publish", late)
    assert runs.compact_runs(spark, folder) == 2
    assert [r[0] for r in _stored(spark, folder)] == ["2", "9"]


def test_a_clock_that_goes_back(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    runs.store_runs(folder, "a", *_tables(spark, [1]))
    monkeypatch.setattr(time, "time_ns", lambda: 0)
    runs.store_runs(folder, "a", *_tables(spark, [2]))
    assert [r[0] for r in _stored(spark, folder)] == ["2"]


def test_embedding_equals_plain_counts(spark):
    choose = random.Random(4)
    words = ["alpha", "Beta", "ü", "x1", "日本", "gamma", "42", "delta"]
    texts = [" ".join(choose.choices(words, k=k)) for k in (0, 1, 2, 3, 50, 5000)] + [None, "!? .", "one one ONE"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for dims in (1, 7, 64):
        for row in vectors.embedded(df, "id", dims=dims).collect():
            counts = [0] * dims
            for word in re.findall(r"[^\W_]+", (texts[row.id] or "").lower()):
                counts[int(hashlib.md5(word.encode()).hexdigest()[:3], 16) % dims] += 1
            length = math.sqrt(sum(c * c for c in counts))
            assert row.embedding == pytest.approx([c / length if length else 0.0 for c in counts], abs=1e-12)
