"""Multinomial models over hashed word n-grams: a trusted target against the raw corpus.

A word's bucket is the lower half of its MD5 modulo ``2**BITS``; a word pair's bucket is made of the
two buckets. So plain SQL can work out the same buckets. Counts cover every document of the corpus;
only the trusted documents are bounded, by ``max_trusted``. ``fit_labelled`` sets the trusted target
against labelled junk instead, so that frequency in the corpus doesn't matter."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesmith.llm.common import Numbers, utf8

BITS = 16
BUCKETS = 1 << BITS
PAIR = 31
#: Weights are whole numbers of 1/SCALE natural logarithms: sums don't depend on their order.
SCALE = 4096
#: Pseudo-count that pulls the ratio of rarely seen buckets to one.
PRIOR = 10.0
MAX_TRUSTED = 50_000


def word_bucket(word: bytes) -> int:
    return int.from_bytes(hashlib.md5(word).digest()[8:], "little") & (BUCKETS - 1)


def grams(words: list[bytes], numbers: Numbers) -> np.ndarray:
    """Buckets of all words, then of all pairs of neighbours (from ``BUCKETS`` on)."""
    one = numbers.of(words, np.int64)
    two = BUCKETS + ((one[:-1] * PAIR + one[1:]) & (BUCKETS - 1))
    return np.concatenate([one, two])


def trusted_ids(labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """Ids of documents labelled good and not toxic: at most ``max_trusted``, in MD5 order of the id."""
    good = labels.where("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(max_trusted)


def junk_ids(labels: DataFrame, most: int = MAX_TRUSTED) -> DataFrame:
    """Ids of documents labelled as of no quality: at most ``most``, in MD5 order of the id."""
    junk = labels.where("quality = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return junk.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(most)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    target, raw, numbers = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64), Numbers(word_bucket)
    for batch in batches:
        for text, trusted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = text.split()
            if not words:
                continue
            found = grams(words, numbers)
            many = len(found) > BUCKETS // 8
            if many:
                n = np.bincount(found, minlength=2 * BUCKETS)
                raw += n
                target += n if trusted else 0
            else:
                np.add.at(raw, found, 1)
                if trusted:
                    np.add.at(target, found, 1)
    used = np.flatnonzero(raw)
    for i in range(0, len(used), 20_000):
        k = used[i : i + 20_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(k), pa.array(target[k]), pa.array(raw[k])], ["bucket", "target", "raw"])


def fit_weights(docs: DataFrame, labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> np.ndarray:
    """Weight of every bucket: log of (target count + prior) / (count expected from the corpus + prior).

    One pass over all documents; a task hands on one row per bucket it used and the driver gets
    ``2 * BUCKETS`` sums, however large the corpus is. No documents: all weights are zero."""
    trusted = trusted_ids(labels, max_trusted).select(F.col("doc_id").alias("_trusted"))
    flagged = docs.select("doc_id", utf8("text").alias("text")).join(
        F.broadcast(trusted), F.col("doc_id") == F.col("_trusted"), "left")  # at most max_trusted ids
    flagged = flagged.select("text", F.col("_trusted").isNotNull().alias("trusted"))
    counts = flagged.mapInArrow(_count, "bucket long, target long, raw long")
    sums = counts.groupBy("bucket").agg(F.sum("target"), F.sum("raw")).collect()
    target, raw = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    for bucket, t, r in sums:
        target[bucket], raw[bucket] = t, r
    return weights(target, raw)


def weights(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    total = raw.sum()
    if not total or not target.sum():
        return np.zeros(len(raw), np.int64)
    expected = raw * target.sum() / total
    return np.round(np.log((target + PRIOR) / (expected + PRIOR)) * SCALE).astype(np.int64)


def fit_labelled(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_TRUSTED) -> np.ndarray:
    """Weight of every bucket: log of its share among trusted documents to its share among junk.

    Only labelled documents count, each distinct text once, so what the corpus holds besides, and how
    often, changes nothing. Without trusted documents or without junk all weights are zero."""
    ids = trusted_ids(labels, max_labelled).select(F.col("doc_id").alias("_labelled"), F.lit(True).alias("trusted"))
    ids = ids.union(junk_ids(labels, max_labelled).select("doc_id", F.lit(False)))
    rows = docs.select("doc_id", utf8("text").alias("text"), F.xxhash64("text").alias("_hash"))
    rows = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("_labelled"))  # at most 2 * max_labelled ids
    texts = rows.select("text", "trusted", "_hash").dropDuplicates(["trusted", "_hash"]).select("text", "trusted")
    counts = texts.mapInArrow(_count, "bucket long, target long, raw long")
    good, junk = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    for bucket, t, r in counts.groupBy("bucket").agg(F.sum("target"), F.sum("raw")).collect():
        good[bucket], junk[bucket] = t, r - t
    return balanced(good, junk)


def balanced(good: np.ndarray, junk: np.ndarray) -> np.ndarray:
    """As ``weights``, for two models that don't contain each other: both are scaled to the same total."""
    g, j = good.sum(), junk.sum()
    if not g or not j:
        return np.zeros(len(good), np.int64)
    return np.round(np.log((good * j / (g + j) + PRIOR) / (junk * g / (g + j) + PRIOR)) * SCALE).astype(np.int64)
