"""Packing by order-preserving dynamic programming.

The documents of a partition are one stream of ids, in their order; each document ends with ``end_id``.
The stream is cut into windows of at most ``size`` ids. Cuts may lie at document ends (free), sentence
ends (cheap) and, inside stretches without either, at every 64th id (dear). A window pays for its
padding to ``size``, none if its length is a power of two. The cheapest cuts are found with a monotone
queue: of all cuts that a window can start from, its front is the best, so that each cut is worked on
once. Blocks of ``BLOCK`` ids are solved in turn; the last window of a block is left for the next one,
and what remains at the stream's end may be split into powers of two. No id is lost or moved.

A null text is an empty one and consists of the end id; a null id stays null; repeated rows are packed
one by one; extra columns are ignored; no documents give no rows. Nothing is shuffled."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesmith.llm.encode import encoder, groups

SIZE, BLOCK = 2048, 1 << 19
#: Costs in padded ids: of a window, of a cut at a sentence end, of a cut elsewhere in a document.
WINDOW_COST, SENTENCE_COST, INNER_COST = 2, 1, 24
GRID, LEAST_POWER = 64, 256


def candidate_cuts(doc_ends: np.ndarray, sentence_ends: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, in order, and what a cut costs there. ``total`` is one of them."""
    marks = np.union1d(doc_ends, sentence_ends)
    marks = marks[marks > 0]
    marks = marks if len(marks) and marks[-1] == total else np.append(marks, total)
    starts = np.concatenate([[0], marks[:-1]])
    inner = (marks - starts - 1) // GRID
    offsets = np.arange(inner.sum()) - np.repeat(np.cumsum(inner) - inner, inner)
    grid = np.repeat(starts, inner) + GRID * (offsets + 1)
    places = np.sort(np.concatenate([marks, grid]))
    costs = np.full(len(places), INNER_COST)
    costs[np.isin(places, sentence_ends)] = SENTENCE_COST
    costs[np.isin(places, doc_ends)] = 0
    return places, costs


def best_cuts(places: np.ndarray, costs: np.ndarray, size: int = SIZE) -> list[int]:
    """The cheapest places to cut, the last place included. From any place the next one must be within
    ``size``."""
    whole = np.concatenate([[0], places])
    powers: dict[int, list[int]] = {}
    length = LEAST_POWER
    while length < size:
        at = np.searchsorted(whole, whole - length)
        for j in np.flatnonzero((whole >= length) & (whole[at] == whole - length)).tolist():
            powers.setdefault(j, []).append(int(at[j]))
        length *= 2
    place, cost = whole.tolist(), [0, *costs.tolist()]
    least, before = [0] * len(place), [0] * len(place)
    queue: deque[int] = deque()  # starts in reach; least[i] + place[i] rises from front to back
    for j in range(1, len(place)):
        i, here = j - 1, place[j]
        key = least[i] + place[i]
        while queue and least[queue[-1]] + place[queue[-1]] >= key:
            queue.pop()
        queue.append(i)
        while place[queue[0]] < here - size:
            queue.popleft()
        start = queue[0]
        best = least[start] + size - (here - place[start])
        for i in powers.get(j, ()):
            if least[i] < best:
                best, start = least[i], i
        least[j], before[j] = best + cost[j] + WINDOW_COST, start
    cuts, j = [], len(place) - 1
    while j > 0:
        cuts.append(place[j])
        j = before[j]
    return cuts[::-1]


def split_tail(length: int, size: int = SIZE) -> list[int]:
    """Lengths for the stream's last window: powers of two, if their cuts cost less than its padding."""
    bits = [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]
    extra = (len(bits) - 1) * (INNER_COST + WINDOW_COST)
    return bits if len(bits) > 1 and extra < size - length else [length]


class Packer:
    """Takes documents' ids in order and gives out the pieces of finished windows."""

    def __init__(self, sentence_end: np.ndarray, size: int = SIZE, block: int = BLOCK):
        self.sentence_end, self.size, self.block = sentence_end, size, block
        self.docs: list[tuple] = []  # key, ids that aren't packed yet, ids packed already
        self.held = self.sequences = 0

    def add(self, key, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append((key, ids, 0))
        self.held += len(ids)
        if self.held >= self.block:
            yield from self._pack(last=False)

    def rest(self) -> Iterator[tuple]:
        if self.held:
            yield from self._pack(last=True)

    def _pack(self, last: bool) -> Iterator[tuple]:
        ids = np.concatenate([d[1] for d in self.docs])
        ends = np.cumsum([len(d[1]) for d in self.docs])
        sentences = np.flatnonzero(self.sentence_end[ids]) + 1
        cuts = best_cuts(*candidate_cuts(ends, sentences, len(ids)), self.size)
        if last:
            start = cuts[-2] if len(cuts) > 1 else 0
            cuts = cuts[:-1] + list(start + np.cumsum(split_tail(cuts[-1] - start, self.size)))
        elif len(cuts) > 1:
            cuts = cuts[:-1]
        done = int(cuts[-1])
        cuts = np.array(cuts)
        bounds = np.union1d(cuts, ends[ends <= done])
        starts = np.concatenate([[0], bounds[:-1]])
        doc = np.searchsorted(ends, starts, side="right").tolist()
        window = np.searchsorted(cuts, starts, side="right")
        offsets = (starts - np.concatenate([[0], cuts])[window]).tolist()
        doc_starts = (ends - [len(d[1]) for d in self.docs]).tolist()
        data = ids.astype("<u4", copy=False)
        for a, b, d, w, offset in zip(starts.tolist(), bounds.tolist(), doc, window.tolist(), offsets, strict=True):
            key, own, packed = self.docs[d]
            yield (key, packed + a - doc_starts[d], b - a, zlib.crc32(data[a:b].tobytes()), packed + len(own),
                   self.sequences + w, offset)
        self.sequences += len(cuts)
        first = int(np.searchsorted(ends, done, side="right"))
        left = self.docs[first:]
        if left and doc_starts[first] < done:
            key, own, packed = left[0]
            gone = done - doc_starts[first]
            left[0] = (key, own[gone:], packed + gone)
        self.docs, self.held = left, len(ids) - done


def sentence_table(tokenizer) -> np.ndarray:
    """Which ids end a sentence: their token ends with a full stop, a question or an exclamation mark."""
    tokens = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
    return np.array([t.removesuffix("</w>")[-1:] in (".", "!", "?") for t in tokens], bool)


def _run(path: str, end_id: int, size: int, key_type: pa.DataType):
    fields = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = pa.schema([("doc_id", key_type), *[(f, pa.int64()) for f in fields]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        packer = Packer(sentence_table(encode.tokenizer), size)
        first = TaskContext.get().partitionId() << 40

        def batch_of(pieces):
            columns = list(zip(*pieces, strict=True))
            columns[5] = [first + s for s in columns[5]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        pieces = []
        end = np.array([end_id], np.uint32)
        for batch in batches:
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for a, b in groups(texts):
                for key, ids in zip(keys[a:b], encode.encode(texts[a:b]), strict=True):
                    pieces.extend(packer.add(key, np.concatenate([ids, end])))
                if len(pieces) >= 10_000:
                    yield batch_of(pieces)
                    pieces = []
        pieces.extend(packer.rest())
        if pieces:
            yield batch_of(pieces)

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, size: int = SIZE) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``sequence_id`` holds the partition's number and the window's number in it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_run(tokenizer_path, end_id, size, pa.int64()), (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"))
