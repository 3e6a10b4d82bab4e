"""Importance resampling towards a target distribution, over words cut by the tokenizers library.

An untrained ``Split`` by a pattern gives each text's words and their offsets. A window of one or two
words is the stretch between its first word's start and its last word's end, with one space for what is
between two words; its bucket is the CRC-32 of these bytes. The CRC of a pair is composed of the two
words' CRCs (appending zero bytes is linear, and so is adding others), so each distinct word is hashed once and pairs are table look-ups.

The texts are cut once: the buckets of each document are written, the histograms of corpus and target are
sums over tasks (``BUCKETS`` rows at most each), and the gains of the written buckets are added up per
document. Ranks are numbered over ranges of sorted keys, never in one task.

Null and empty texts have no words; a null id counts as an empty one in the noise and comes first among
ties; repeated rows count, and are drawn, one by one; other columns are ignored. No documents give no
rows; without target texts every gain follows from the formula as it stands. Bytes that aren't UTF-8
count as the replacement character."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesmith.cluster import cut_lineage
from pagesmith.llm.common import Numbers, utf8

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Words up to this many bytes are appended by tables; longer ones by hashing their bytes.
TABLED = 64
_EMPTY, _LOW = np.zeros(0, np.int16), np.uint32(255)


def splitter():
    """Cuts a text into words with their offsets: nothing is trained."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(PATTERN), "removed", invert=True)


def lower_ascii(text: bytes) -> str:
    return text.lower().decode("utf-8", "replace")


def shift_tables(most: int = TABLED) -> np.ndarray:
    """``tables[n, k, b]``: what byte k with value b of a CRC becomes when n zero bytes are appended."""
    one = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
    one ^= one[0]  # without the constant that every CRC has: one step is linear in its byte
    tables = np.zeros((most + 1, 4, 256), np.uint32)
    for k in range(4):
        tables[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, most + 1):
        before = tables[n - 1]
        tables[n] = (before >> np.uint32(8)) ^ one[before & np.uint32(255)]
    return tables


class Hasher:
    """Buckets of all windows of one or two words. Holds a number per distinct word, bounded."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.tables = buckets, shift_tables()
        self.packed = Numbers(self._pack)
        #: A space's CRC with n zero bytes appended.
        self.space = self._appended(np.full(TABLED, zlib.crc32(b" "), np.uint32), np.arange(TABLED))

    @staticmethod
    def _pack(word: str) -> int:
        """The CRC of the word's bytes and above it their number, 0 if the tables don't go so far."""
        data = word.encode()
        return zlib.crc32(data) | (len(data) if len(data) < TABLED else 0) << 32

    def windows(self, words: list[str]) -> np.ndarray:
        if not words:
            return _EMPTY
        packed = self.packed.of(words, np.int64)
        crc = (packed & 0xFFFFFFFF).astype(np.uint32)
        size = (packed >> 32)[1:]
        pairs = crc[1:] ^ self._appended(crc[:-1], size + 1) ^ self.space[size]
        for i in np.flatnonzero(size == 0).tolist():
            pairs[i] = zlib.crc32(b" " + words[i + 1].encode(), int(crc[i]))
        return (np.concatenate([crc, pairs]) % np.uint32(self.buckets)).astype(np.int16)

    def _appended(self, crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
        out = self.tables[zeros, 0, crc & _LOW]
        for k in (1, 2, 3):
            out ^= self.tables[zeros, k, (crc >> np.uint32(8 * k)) & _LOW]
        return out


def _cut(buckets: int):
    """``features`` of every text: the buckets of its windows, single words first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, hasher = splitter(), Hasher(buckets)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for i in range(0, len(batch), 500):
                found = [hasher.windows([w for w, _ in split.pre_tokenize_str(lower_ascii(t))]) for t in texts.slice(i, 500).to_pylist()]
                ends = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(f) for f in found], out=ends[1:])
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([_EMPTY, *found])))
                part = batch.slice(i, 500)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], [*part.schema.names[:-1], "features"])

    return run


def _count(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=buckets)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], ["bucket", "held"])

    return run


def histogram(cut: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features lie in each bucket: ``buckets`` sums, whatever the number of texts is."""
    counts = cut.select("features").mapInArrow(_count(buckets), "bucket long, held long")
    found = np.zeros(buckets, np.int64)
    for bucket, held in counts.groupBy("bucket").agg(F.sum("held")).collect():
        found[bucket] = held
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist(), strict=True)], np.int64)


def _sum(table: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(table[lists.flatten().to_numpy(zero_copy_only=False)])])
            ends = np.cumsum(sizes)
            weight = (sums[ends] - sums[ends - sizes]) // np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(sizes), pa.array(weight)], ["doc_id", "row", "n_features", "weight"])

    return run


def noise(seed: int = SEED):
    """Thousandths of Gumbel noise, drawn from a hash of the id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, most: int) -> DataFrame:
    """``rank`` of the ``most`` highest scores, ties to the smaller id; null for the others. The rows are sorted
    in ranges and numbered in each; the ranges' sizes, a row per range, give where each begins."""
    keys = [F.desc("score"), F.asc("doc_id"), F.asc("row")]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    placed = cut_lineage(placed)
    part = F.shiftright("place", 33)
    begins, at = {}, 0
    for p, n in sorted(map(tuple, placed.groupBy(part.alias("p")).count().collect())):
        begins[p], at = at, at + n
    starts = rows.sparkSession.createDataFrame(list(begins.items()) or [(0, 0)], "p long, begin long")
    numbered = placed.withColumn("p", part).join(F.broadcast(starts), "p")  # a row per range
    rank = F.col("begin") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return numbered.select("doc_id", "n_features", "weight", "score", F.when(rank <= most, rank).alias("rank"))


def target_sample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
                  buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` numbers the drawn ones.

    ``buckets`` may be 32,767 at most."""
    if not 0 < buckets <= 32_767:
        raise ValueError("1 to 32767 buckets")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), utf8("text").alias("text"))
    cut = cut_lineage(rows.mapInArrow(_cut(buckets), "doc_id long, row long, features array<short>"))
    wanted = target.select(utf8("text").alias("text")).mapInArrow(_cut(buckets), "features array<short>")
    table = gains(histogram(cut, buckets), histogram(wanted, buckets))
    weighed = cut.mapInArrow(_sum(table), "doc_id long, row long, n_features long, weight long")
    scored = cut_lineage(weighed.withColumn("score", F.col("weight") + noise(seed)))
    fits = F.col("n_features") >= 2 * min_words - 1  # so many words have so many windows
    most = percent * scored.where(fits).count() // 100
    rest = scored.where(~fits).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked(scored.where(fits), most).unionByName(rest)
