"""Recursive text splitting into overlapping chunks (Arrow batches).

A text no longer than ``chunk_size`` always gives exactly one chunk, its stripped self, and that
case is decided inside the JVM. Only the longer texts travel to the Python workers.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import strip_ws

CHUNK_SIZE = 10_000
CHUNK_OVERLAP = 1_000
# Separators from coarse to fine; the last one means single characters.
SEPARATORS = ("\n\n", "\n", " ", "")

CHUNK_TYPE = T.ArrayType(
    T.StructType(
        [T.StructField("chunk_idx", T.IntegerType()), T.StructField("text", T.StringType())]
    )
)


def _windows(text: str, cuts: list[int], size: int, overlap: int) -> Iterator[str]:
    """Greedy windows over contiguous pieces; ``cuts`` are the piece borders, ends included.

    A window grows while it fits ``size``. The next one starts at the first piece that leaves at
    most ``overlap`` characters of the old window and still has room for the next piece."""
    first, last = 0, len(cuts) - 1
    while first < last:
        end = bisect_right(cuts, cuts[first] + size, first + 1) - 1
        end = max(end, first + 1)
        window = text[cuts[first] : cuts[end]].strip()
        if window:
            yield window
        if end == last:
            return
        nxt = first
        while nxt < end and (
            cuts[end] - cuts[nxt] > overlap or cuts[end + 1] - cuts[nxt] > size
        ):
            nxt += 1
        first = nxt


def split_text(text: str, size: int, overlap: int, separators=SEPARATORS) -> list[str]:
    """Chunks of one text. Every separator stays at the start of the piece that follows it."""
    level = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    sep, finer = separators[level], separators[level + 1 :]
    if sep:
        cuts = [m.start() for m in re.finditer(re.escape(sep), text)]
        cuts = ([0] if not cuts or cuts[0] else []) + cuts + [len(text)]
    else:
        cuts = list(range(len(text) + 1))
    chunks: list[str] = []
    run = [cuts[0]]  # borders of the pending run of pieces shorter than `size`
    for start, end in zip(cuts, cuts[1:]):
        if end - start < size:
            run.append(end)
            continue
        chunks += _windows(text, run, size, overlap)
        piece = text[start:end]
        chunks += split_text(piece, size, overlap, finer) if finer else [piece]
        run = [end]
    chunks += _windows(text, run, size, overlap)
    return chunks


def chunk_text(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """ARRAY<STRUCT<chunk_idx, text>> of a text column."""
    if not 0 <= overlap <= size:
        raise ValueError("overlap must lie between 0 and the chunk size")

    @F.pandas_udf(CHUNK_TYPE)
    def split_long(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda t: None if t is None else list(enumerate(split_text(t, size, overlap)))
        )

    is_long = F.length(text) > size
    stripped = strip_ws(text)
    single = F.when(
        stripped != "", F.array(F.struct(F.lit(0).alias("chunk_idx"), stripped.alias("text")))
    ).otherwise(F.array().cast(CHUNK_TYPE))
    return F.when(is_long, split_long(F.when(is_long, text))).otherwise(single)
