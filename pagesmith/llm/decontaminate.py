"""Benchmark decontamination: document windows looked up in a hash set of the benchmark's n-grams.

Texts are normalised (A-Z lower-cased, words are runs of ASCII letters and digits and of all characters
beyond ASCII). Every ``size`` consecutive words of an item are a window; an item of fewer words is one
window. The hash of each of their windows is looked up in the set of the
benchmark's, and what is found is verified by the words themselves. The hashes are counted first: up to
``ROUND`` of them travel with the plan, more are joined with those of all document windows by a shuffle.

Null and empty texts have no words and are never hit; a null item id counts for hits but isn't listed;
repeated documents are judged alike, each for itself; extra columns are ignored by ``contamination`` and
kept by the functions that filter; no documents give no rows and no items hit nothing. Only DataFrame
functions run here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagesmith.cluster import cut_lineage
from pagesmith.llm.common import clean, key_columns, whole_row

SIZE = 10
#: Hashes of benchmark windows that travel with the plan; more are joined by a shuffle.
ROUND = 100_000
#: Sub-keys of each hash in that join.
SALTS = 8
#: Fixed value: the characters between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The normalised words. ``lower`` is right, and much quicker, where all characters are ASCII."""
    plain = F.length(text) == F.octet_length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), f"{BETWEEN}+"), "")


def count_words(text: Column) -> Column:
    """How many words a text has, whatever their case."""
    found = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")
    return F.size(found).cast("long")


def _window(words: str, at: Column, k: int) -> Column:
    """``k`` words from place ``at`` on, joined. Single elements are read, as ``slice`` copies the whole
    array every time."""
    return F.concat_ws(" ", *[F.get(F.col(words), at + i) for i in range(k)])


def item_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """``item_id, k, h, w``: every item's windows, with their number of words and their hash."""
    rows = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where("size(words) > 0")
    n = F.size("words")
    rows = rows.select("item_id", "words", F.least(n, F.lit(size)).alias("k"), F.explode(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))).alias("at"))
    window = F.when(F.size("words") < size, F.array_join("words", " ")).otherwise(_window("words", F.col("at"), size))
    return rows.select("item_id", "k", window.alias("w")).distinct().select("item_id", "k", F.xxhash64("w").alias("h"), "w")


def _found(rows: DataFrame, k: int, hashes: list[int]) -> DataFrame:
    """``_id, _hash, at, k, w``: document windows of ``k`` words whose hash is one of ``hashes``. No filter
    stands on what is computed here: it would be pushed down and computed twice."""
    every = F.transform(F.sequence(F.lit(0), F.size("words") - k), lambda i: F.struct(
        i.alias("at"), F.xxhash64(_window("words", i, k)).alias("h")))
    some = F.filter(F.when(F.size("words") >= k, every), lambda x: x["h"].isin(hashes))
    sought = rows.select("_id", "_hash", "words", some.alias("some"))
    windows = F.transform("some", lambda x: F.struct(x["at"].alias("at"), _window("words", x["at"], k).alias("w")))
    hit = sought.select("_id", "_hash", F.inline_outer(windows)).where("at IS NOT NULL")
    return hit.select("_id", "_hash", "at", F.lit(k).alias("k"), "w")


def _joined(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """As :func:`_found` for hashes of any number: those of all document windows are joined with them. The
    windows of one very common hash are dealt over ``SALTS`` sub-keys, the benchmark's hashes are copied to each."""
    lengths = sorted(r.k for r in keys.select("k").distinct().collect())  # at most as many as words in a window

    def windows(k: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size("words") - k), lambda i: F.struct(
            i.alias("at"), F.lit(k).alias("k"), F.xxhash64(_window("words", i, k)).alias("h")))

    every = F.flatten(F.array_compact(F.array(*[F.when(F.size("words") >= k, windows(k)) for k in lengths])))
    dealt = rows.select("_id", "_hash", F.inline_outer(every)).where("at IS NOT NULL")
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("_id", "_hash", "at"), F.lit(SALTS)).cast("int"))
    copied = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = dealt.join(copied, ["k", "h", "salt"]).select("_id", "_hash", "at", "k")
    text = F.coalesce(*[F.when(F.col("k") == k, _window("words", F.col("at"), k)) for k in lengths])
    return met.join(rows, ["_id", "_hash"]).select("_id", "_hash", "at", "k", text.alias("w"))


def hits(docs: DataFrame, windows: DataFrame, round_size: int = ROUND) -> DataFrame:
    """``_id, _hash, at, k, w``: where windows of the benchmark occur in the documents."""
    keys = windows.select("k", "h").distinct()
    rows = docs.select(*key_columns(), words_of(F.col("text")).alias("words"))
    if keys.count() > round_size:
        found = _joined(rows, keys)
    else:
        told = [(r.k, r.h) for r in keys.collect()]  # at most round_size
        scans = [_found(rows, k, sorted(h for n, h in told if n == k)) for k in sorted({k for k, _ in told})]
        if not scans:
            return rows.where("false").select("_id", "_hash", F.lit(0).alias("at"), F.lit(0).alias("k"), F.lit("").alias("w"))
        found = reduce(DataFrame.union, scans)
    sure = windows.select("k", "w").distinct()
    return found.select("_id", "_hash", "at", "k", "w").distinct().join(sure, ["k", "w"])


def hit_spans(found: DataFrame) -> DataFrame:
    """``_id, _hash, n_hit, spans``: number of words inside hits, and the spans (from, up to) they fill."""
    end = F.col("at") + F.col("k")
    before = Window.partitionBy("_id", "_hash").orderBy("at", "k").rowsBetween(Window.unboundedPreceding, -1)
    parts = found.select("_id", "_hash", "at", end.alias("end"), F.max(end).over(before).alias("reached"))
    start = F.greatest("at", F.coalesce("reached", "at"))
    parts = parts.select("_id", "_hash", start.alias("start"), "end").where("end > start")
    return parts.groupBy("_id", "_hash").agg(
        F.sum((F.col("end") - F.col("start")).cast("long")).alias("n_hit"), F.collect_list(F.struct("start", "end")).alias("spans"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, round_size: int = ROUND) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row of ``docs``."""
    windows = cut_lineage(item_windows(benchmark, size))
    found = cut_lineage(hits(docs, windows, round_size))
    spans = hit_spans(found).select("_id", "_hash", "n_hit")
    items = found.select("_id", "_hash", "k", "w").distinct().join(windows.select("k", "w", "item_id"), ["k", "w"])
    listed = items.where("item_id IS NOT NULL").select("_id", "_hash", F.col("item_id").cast("string").alias("item")).distinct()
    listed = listed.groupBy("_id", "_hash").agg(F.sort_array(F.collect_list("item")).alias("items"))
    of_hit = spans.join(listed, ["_id", "_hash"], "left")
    rows = docs.select(*key_columns(), count_words(F.col("text")).alias("n_words"))
    names = F.array_join(F.coalesce("items", F.array().cast("array<string>")), ",").cast("binary")
    return rows.join(of_hit, ["_id", "_hash"], "left").select(
        clean(F.col("_id")).alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, round_size: int = ROUND) -> DataFrame:
    """The documents without any hit, all columns as they were."""
    windows = cut_lineage(item_windows(benchmark, size))
    found = hits(docs, windows, round_size).select("_id", "_hash").distinct()
    rows = docs.select(whole_row(docs), *key_columns())
    return rows.join(found, ["_id", "_hash"], "left_anti").select("_row.*")


def cut_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, round_size: int = ROUND) -> DataFrame:
    """All documents, without the words inside hits and what stands between them and the next word."""
    spans = hit_spans(hits(docs, item_windows(benchmark, size), round_size)).select("_id", "_hash", "spans")
    rows = docs.select(whole_row(docs), *key_columns(), F.col("text").alias("_text"))
    marked = rows.join(spans, ["_id", "_hash"], "left")
    words = F.regexp_extract_all("_text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"), F.lit(0))
    kept = F.filter(words, lambda w, i: ~F.exists("spans", lambda s: (i >= s["start"]) & (i < s["end"])))
    lead = F.regexp_extract("_text", r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    text = F.when(F.col("spans").isNull(), F.col("_text")).otherwise(F.concat(lead, F.array_join(kept, "")))
    return marked.select(*[(text if c == "text" else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
