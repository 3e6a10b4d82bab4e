"""Quality rules: countable base rules, then the log-likelihood ratio of hashed n-grams.

``quality_scores`` judges every document. A document that passes the base rules is kept if the mean
weight of its n-grams (trusted target against raw corpus) reaches the threshold; ``keep_likely`` takes
labelled junk in place of the corpus, and so doesn't reject what is merely frequent. All sums are whole
numbers, so that the verdict is the same in any order and on any cluster.

Words are runs of other characters than ASCII white space. Null and empty texts have no words and
fail the base rules; repeated rows are judged alike, each for itself; extra columns are ignored by
``quality_scores`` and kept by the functions that filter; no documents give no rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesmith.llm.common import Numbers, Rows, utf8, whole_row
from pagesmith.llm.ngram_models import MAX_TRUSTED, SCALE, fit_labelled, fit_weights, grams, word_bucket

MIN_WORDS = 50
#: Symbols that the base counts name.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
#: Mean log-likelihood ratio per n-gram that a document must reach.
THRESHOLD = -0.08
#: The same against labelled junk: as likely a good document as junk.
EVEN = 0.0

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCORE_TYPES = ", ".join(f"{c} long" for c in (*COUNTS, "n_grams", "weight_sum"))


def code_points(data: bytes) -> int:
    return len(data) - len(data.translate(None, _LEAD)) if data else 0


#: Bytes that begin a UTF-8 character.
_LEAD = bytes([*range(0x80), *range(0xC0, 0x100)])


def repeated_words(numbers: np.ndarray) -> int:
    """How many words lie in 3-word windows that occur at least twice; equal numbers mean equal words."""
    n = len(numbers)
    if n < 4:
        return 0
    small = np.unique(numbers, return_inverse=True)[1].astype(np.int64)
    if small.max() < 1 << 21:
        keys = (small[:-2] << 42) | (small[1:-1] << 21) | small[2:]
    else:
        pairs = np.unique((small[:-1] << 32) | small[1:], return_inverse=True)[1].astype(np.int64)
        keys = (pairs[:-1] << 32) | small[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[i : n - 2 + i] |= twice
    return int(covered.sum())


class Ordinals(dict):
    """word -> running number, within one document."""

    def __missing__(self, word):
        value = self[word] = len(self)
        return value


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    packed = text.translate(None, SPACES)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    ordinals = Ordinals()
    numbers = np.fromiter(map(ordinals.__getitem__, words), np.int64, len(words))
    return len(words), code_points(packed), symbols, len(lines) - len(set(lines)), repeated_words(numbers)


def _scorer(weights: np.ndarray):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, schema = Numbers(word_bucket), None
        for batch in batches:
            carried = [f for f in batch.schema if f.name != "_text"]
            names = [*COUNTS, "n_grams", "weight_sum"]
            schema = pa.schema([(n, pa.int64()) for n in names])
            out = Rows(schema, rows=1 << 60)
            for text in batch.column("_text").to_pylist():
                words = text.split()
                found = grams(words, numbers) if words else np.zeros(0, np.int64)
                out.add(*base_counts(text, words), len(found), int(weights[found].sum()))
            made = out.take()
            arrays = [*[batch.column(f.name) for f in carried], *made.columns]
            yield pa.RecordBatch.from_arrays(arrays, [*[f.name for f in carried], *names])

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                   max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """``doc_id``, the base counts, ``n_grams``, ``weight_sum``, ``base_failed`` and ``kept`` per document.

    Two scans of the texts: one fits the models over all documents, one judges. Neither shuffles texts."""
    fitted = fit_weights(docs, labels, max_trusted).astype(np.int32)
    rows = docs.select("doc_id", utf8("text").alias("_text"))
    scored = rows.mapInArrow(_scorer(fitted), f"{_typed(docs, 'doc_id')}, {SCORE_TYPES}")
    return _judged(scored, threshold)


def _typed(docs: DataFrame, name: str) -> str:
    return f"`{name}` {docs.schema[name].dataType.simpleString()}"


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    likely = F.col("weight_sum") >= F.lit(round(threshold * SCALE)) * F.col("n_grams")
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & likely)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
              max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """The documents that the rules keep, all columns as they were."""
    fitted = fit_weights(docs, labels, max_trusted).astype(np.int32)
    return _kept(docs, fitted, threshold)


def keep_likely(docs: DataFrame, labels: DataFrame, threshold: float = EVEN,
                max_labelled: int = MAX_TRUSTED) -> DataFrame:
    """As ``keep_good``, by models of good and junk documents: a document's verdict depends on its text and
    the labelled documents only, not on how frequent its text, source or language is."""
    fitted = fit_labelled(docs, labels, max_labelled).astype(np.int32)
    return _kept(docs, fitted, threshold)


def _kept(docs: DataFrame, fitted: np.ndarray, threshold: float) -> DataFrame:
    carried = docs.select(whole_row(docs), utf8("text").alias("_text"))
    schema = f"_row {carried.schema['_row'].dataType.simpleString()}, {SCORE_TYPES}"
    return _judged(carried.mapInArrow(_scorer(fitted), schema), threshold).where("kept").select("_row.*")
