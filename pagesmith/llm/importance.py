"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

A document's log importance weight is the sum, over its words and word pairs, of the log ratio between
the trusted target's and the raw corpus's models. Adding Gumbel noise, drawn from a hash of the document
and the seed, and taking the k largest is sampling k documents without replacement in proportion to the
weights. The k-th largest key is found by counting digits of all keys, most significant first: 4 counts
of 65,536 rows at most, wherever the documents are, instead of sorting or gathering them.

Null and empty texts have weight zero; a null id is an id like others; repeated rows have equal keys and
are taken or left together, so they can make the sample larger; extra columns are ignored; no documents
give no rows, and no trusted labels make all weights zero (an even sample)."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesmith.cluster import cut_lineage
from pagesmith.llm.common import Numbers, clean, keyed
from pagesmith.llm.ngram_models import MAX_TRUSTED, SCALE, fit_weights, grams, word_bucket

#: Share of the documents that the sample takes.
SHARE = 0.85
SEED = 42


def _weigh(weights: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(word_bucket)
        for batch in batches:
            counts, sums = [], []
            for text in batch.column("_text").to_pylist():
                words = text.split()
                found = grams(words, numbers) if words else np.zeros(0, np.int64)
                counts.append(len(found))
                sums.append(int(weights[found].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_hash"), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                ["_id", "_hash", "n_grams", "weight_sum"])

    return run


def gumbel(seed: int, *columns: str) -> Column:
    """Standard Gumbel noise from a hash: the same for the same document and seed."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def _ordered(key: Column) -> Column:
    """A double as a whole number of the same order (millionths; ties go by id afterwards)."""
    return F.round(key * 1_000_000).cast("long") + F.lit(1 << 62)


def kth_largest(keys: DataFrame, k: int) -> tuple[int, int]:
    """The k-th largest ``key`` (a long of 0 to 2**63 - 1) and how many rows with just that key the k hold."""
    found, left = 0, k
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned("key", shift).bitwiseAND(F.lit(0xFFFF))
        rest = keys if shift == 48 else keys.where(F.shiftrightunsigned("key", shift + 16) == F.lit(found))
        counts = sorted(map(tuple, rest.groupBy(digit.alias("d")).count().collect()), reverse=True)
        for d, n in counts:
            if n >= left:
                found = (found << 16) | d
                break
            left -= n
    return found, left


def resample(docs: DataFrame, labels: DataFrame, share: float = SHARE, seed: int = SEED,
             max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """``doc_id, n_grams, log_weight, sample_key, kept`` of every row: ``kept`` marks the sample."""
    fitted = fit_weights(docs, labels, max_trusted).astype(np.int32)
    weighed = keyed(docs).mapInArrow(_weigh(fitted), "_id long, _hash long, n_grams long, weight_sum long")
    log_weight = F.col("weight_sum") / float(SCALE)
    scored = weighed.select("_id", "_hash", "n_grams", log_weight.alias("log_weight"),
                            (log_weight + gumbel(seed, "_id", "_hash")).alias("sample_key"))
    scored = cut_lineage(scored.withColumn("key", _ordered(F.col("sample_key"))))
    k = math.ceil(share * scored.count())
    edge = F.lit(False)
    taken = F.lit(False)
    if k:
        least, ties = kth_largest(scored, k)
        taken = F.col("key") > F.lit(least)
        tied = scored.where(F.col("key") == F.lit(least)).select(
            F.shiftrightunsigned(F.xxhash64("_id", "_hash"), 1).alias("key"))  # among ties, by hash
        last, _ = kth_largest(tied, ties)
        edge = (F.col("key") == F.lit(least)) & (F.shiftrightunsigned(F.xxhash64("_id", "_hash"), 1) >= F.lit(last))
    return scored.select(clean(F.col("_id")).alias("doc_id"), "n_grams", "log_weight", "sample_key", (taken | edge).alias("kept"))
