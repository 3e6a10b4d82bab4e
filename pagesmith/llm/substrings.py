"""Exact substring dedup: suffix automata over shards of repeated text, documents streamed for matches.

A word goes if a window of ``window`` consecutive words covers it whose word sequence also starts
anywhere else, in the same document or another. The steps:

1. Every window has an anchor, its smallest hashed ``GRAM``-word gram, so equal windows have equal
   anchors. A document's windows with the same anchor make one piece (anchor, digest of the words).
2. Only pieces whose anchor occurs more than once go on. Equal pieces become one, with a count.
3. Pieces are dealt by anchor into shards of bounded size. A shard's suffix automaton counts how often
   each of its substrings occurs; each piece is streamed through it for matching statistics: how long
   is the longest suffix, at each word, that occurs at least twice. From ``window`` words on, it goes.
4. What was found in a piece holds for all documents that have it.

An automaton of all repeated text would grow with the corpus, so it isn't broadcast whole: a piece meets
just the shard that can match it. Anchors shared by very many different pieces are dealt by their whole
windows instead, so that no group is unbounded. Hashes only choose what meets; words decide.

Null and empty texts have no words; repeated rows are occurrences of their own; a null id is an id like
others; extra columns are ignored by ``repeat_report`` and kept by ``remove_repeats``; no documents give
no rows."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pagesmith.cluster import cut_lineage, settled
from pagesmith.llm.common import Numbers, Rows, clean, key_columns, keyed, mix, rows_of

WINDOW, GRAM = 35, 8
#: Words of one shard's automaton, and different pieces of one anchor before its windows are dealt apart.
SHARD_WORDS, HOT_PIECES = 20_000, 128

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK_BITS = 20


class Powers:
    """Powers of the hash base and of its inverse, as far as they were needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n >= len(self.up):
            size = max(n + 1, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                values = np.full(size, base, np.uint64)
                values[0] = 1
                setattr(self, name, np.multiply.accumulate(values))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors_of(numbers: np.ndarray, powers: Powers, window: int = WINDOW, gram: int = GRAM):
    """(first window, number of windows, anchor, digest of the words) of a document's pieces.

    ``numbers`` are the words' hashes. Long documents are worked through in parts of 2**20 words; each
    window belongs to one part, and ties between equal grams go to the first, so equal windows always
    choose alike."""
    n = len(numbers)
    powers.reach(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(numbers * powers.up[:n], out=sums[1:])
    grams = mix((sums[gram:] - sums[:-gram]) * powers.down[: n + 1 - gram])
    firsts, counts, keys = [], [], []
    low = np.uint64((1 << _CHUNK_BITS) - 1)
    span = window - gram + 1
    step = (1 << _CHUNK_BITS) - span
    for start in range(0, n - window + 1, step):
        end = min(start + step, n - window + 1)
        part = grams[start : end + span - 1]
        marked = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        at = (_sliding_min(marked, span) & low).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        firsts.append(start + cuts)
        counts.append(np.diff(np.concatenate([cuts, [len(at)]])))
        keys.append(part[at[cuts]])
    first, count = np.concatenate(firsts), np.concatenate(counts)
    end = first + count + window - 1
    digest = mix(((sums[end] - sums[first]) * powers.down[first]) ^ (count.astype(np.uint64) << np.uint64(40)))
    return first, count, np.concatenate(keys), digest


def word_hash(word: bytes) -> int:
    return xxh64_intdigest(word, 9)


def _anchors(window: int, gram: int):
    names = ["_id", "_hash", "first", "n", "anchor", "digest"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, powers = Numbers(word_hash), Powers()
        for batch in batches:
            made = []
            ids, hashes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_id", "_hash"))
            for row, text in enumerate(batch.column("_text").to_pylist()):
                words = text.split()
                if len(words) >= window:
                    first, count, key, digest = anchors_of(numbers.of(words), powers, window, gram)
                    made.append((np.full(len(first), row), first, count, key, digest))
            if made:
                row, first, count, key, digest = (np.concatenate(x) for x in zip(*made, strict=True))
                arrays = [ids[row], hashes[row], first.astype(np.int32), count.astype(np.int32),
                          key.view(np.int64), digest.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)

    return run


def _texts(window: int):
    """Cuts the chosen pieces out of a document; pieces of a hot anchor are cut into their windows."""
    schema = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("key", pa.int64()), ("part", pa.int64()),
                        ("offset", pa.int32()), ("copies", pa.int64()), ("piece", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for text, pieces in rows_of(batches, "_text", "pieces"):
            words = text.split()
            for p in pieces:
                own = words[p["first"] : p["first"] + p["n"] + window - 1]
                anchor, digest = p["anchor"], p["digest"]
                if not p["hot"]:
                    piece = b" ".join(own)
                    if out.add(anchor, digest, anchor, digest, 0, p["copies"], piece, size=len(piece)):
                        yield out.take()
                    continue
                for i in range(p["n"]):
                    piece = b" ".join(own[i : i + window])
                    key = xxh64_intdigest(piece, 1) - (1 << 63)
                    part = xxh64_intdigest(piece, 2) - (1 << 63)
                    if out.add(anchor, digest, key, part, i, p["copies"], piece, size=len(piece)):
                        yield out.take()
        yield from out.rest()

    return run


class SuffixAutomaton:
    """The substrings of several word sequences, each with the number of places where it ends."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, after: dict, link: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.length) - 1

    def _split(self, source: int, word, target: int) -> int:
        """A copy of ``target`` for what reaches it over ``source`` by ``word``."""
        copy = self._state(self.length[source] + 1, dict(self.next[target]), self.link[target])
        while source >= 0 and self.next[source].get(word) == target:
            self.next[source][word] = copy
            source = self.link[source]
        self.link[target] = copy
        return copy

    def add(self, words: list, copies: int) -> None:
        last, after, length, link = 0, self.next, self.length, self.link
        for word in words:
            known = after[last].get(word)
            if known is not None:
                last = known if length[known] == length[last] + 1 else self._split(last, word, known)
            else:
                new, source = self._state(length[last] + 1, {}, 0), last
                while source >= 0 and word not in after[source]:
                    after[source][word] = new
                    source = link[source]
                if source >= 0:
                    target = after[source][word]
                    link[new] = (
                        target if length[target] == length[source] + 1 else self._split(source, word, target))
                last = new
            self.count[last] += copies

    def settle(self) -> None:
        """Sum the counts up the links; then ``repeated`` names, for each state, the longest suffix
        that ends in two places or more."""
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        link, count = self.link, self.count
        for state in reversed(order[1:]):
            count[link[state]] += count[state]
        self.repeated = [0] * len(order)
        for state in order[1:]:
            self.repeated[state] = state if count[state] > 1 else self.repeated[link[state]]

    def matches(self, words: list) -> list[int]:
        """Matching statistics: length of the longest suffix, at each word, that occurs at least twice."""
        state, out = 0, []
        for i, word in enumerate(words):
            state = self.next[state][word]
            top = self.repeated[state]
            out.append(i + 1 if top == state else self.length[top])
        return out


def _matched(window: int, shard_words: int):
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("key", pa.int64()), ("part", pa.int64()), ("spans", spans)])

    def of(shard: list) -> Iterator[tuple]:
        automaton = SuffixAutomaton()
        for _, _, copies, words in shard:
            automaton.add(words, copies)
        automaton.settle()
        for key, part, _, words in shard:
            found: list[list[int]] = []
            for i, length in enumerate(automaton.matches(words)):
                if length >= window:
                    if found and found[-1][1] >= i + 1 - window:
                        found[-1][1] = i + 1
                    else:
                        found.append([i + 1 - window, i + 1])
            if found:
                yield key, part, [{"start": a, "end": b} for a, b in found]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by key; a shard ends between two keys, when it has enough words."""
        out, shard, held, last = Rows(schema), [], 0, None
        for key, part, copies, piece in rows_of(batches, "key", "part", "copies", "piece"):
            if held >= shard_words and key != last:
                for row in of(shard):
                    if out.add(*row):
                        yield out.take()
                shard, held = [], 0
            words = piece.split(b" ")
            shard.append((key, part, copies, words))
            held, last = held + len(words), key
        for row in of(shard):
            if out.add(*row):
                yield out.take()
        yield from out.rest()

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS,
                   hot_pieces: int = HOT_PIECES) -> DataFrame:
    """``_id, _hash, spans``: for each document with repeated windows, the words to remove (from, up to)."""
    return settled(lambda: _spans(keyed(docs), window, gram, shard_words, hot_pieces))


def _shared(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """The pieces whose anchor occurs more than once."""
    anchors = cut_lineage(texts.mapInArrow(
        _anchors(window, gram), "_id long, _hash long, first int, n int, anchor long, digest long"))
    # written, so that both sides of the join come straight from a shuffle and a hot anchor can be split
    often = cut_lineage(anchors.groupBy("anchor").count().where("count > 1").select("anchor"))
    return anchors.join(often, "anchor")


def _spans(texts: DataFrame, window: int, gram: int, shard_words: int, hot_pieces: int) -> DataFrame:
    shared = settled(lambda: _shared(texts, window, gram))
    pieces = shared.groupBy("anchor", "digest").agg(
        F.count("*").alias("copies"), F.min(F.struct("_id", "_hash", "first", "n")).alias("at"))
    hot = pieces.groupBy("anchor").count().where(F.col("count") > hot_pieces).select("anchor", F.lit(True).alias("hot"))
    chosen = pieces.join(hot, "anchor", "left").select(
        "at._id", "at._hash", F.struct("at.first", "at.n", "anchor", "digest", "copies",
                                       F.coalesce("hot", F.lit(False)).alias("hot")).alias("piece"))
    by_document = chosen.groupBy("_id", "_hash").agg(F.collect_list("piece").alias("pieces"))
    sources = texts.join(by_document, ["_id", "_hash"]).dropDuplicates(["_id", "_hash"]).select("_text", "pieces")
    cut = cut_lineage(sources.mapInArrow(
        _texts(window),
        "anchor long, digest long, key long, part long, offset int, copies long, piece binary"))
    units = cut.groupBy("key", "part").agg(F.sum("copies").alias("copies"), F.min("piece").alias("piece"))
    dealt = units.repartition("key").sortWithinPartitions("key")
    found = cut_lineage(dealt.mapInArrow(
        _matched(window, shard_words), "key long, part long, spans array<struct<start:int,end:int>>"))
    # what was found in a window of a hot anchor's piece, seen from the piece
    split = cut.where((F.col("key") != F.col("anchor")) | (F.col("part") != F.col("digest")))
    windows = split.select("anchor", "digest", "key", "part", "offset").join(found.select("key", "part"), ["key", "part"])
    whole = windows.groupBy("anchor", "digest").agg(F.collect_set(
        F.struct(F.col("offset").alias("start"), (F.col("offset") + window).alias("end"))).alias("spans"))
    in_pieces = found.select(F.col("key").alias("anchor"), F.col("part").alias("digest"), "spans").union(whole)
    placed = shared.join(in_pieces, ["anchor", "digest"]).select("_id", "_hash", "first", F.explode("spans").alias("s"))
    span = F.struct((F.col("first") + F.col("s.start")).alias("start"), (F.col("first") + F.col("s.end")).alias("end"))
    return placed.groupBy("_id", "_hash").agg(F.collect_set(span).alias("spans"))


def _removed(n: int, spans: list | None) -> np.ndarray:
    gone = np.zeros(n, bool)
    for s in spans or ():
        gone[s["start"] : s["end"]] = True
    return gone


def _report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    out = Rows(schema)
    for key, text, spans in rows_of(batches, "_id", "_text", "spans"):
        words = text.split()
        gone = _removed(len(words), spans)
        kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if spans else words
        if out.add(key, len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()):
            yield out.take()
    yield from out.rest()


def repeat_report(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the SHA-256 of the kept words of every row."""
    marked = keyed(docs).join(repeated_spans(docs, window, **options), ["_id", "_hash"], "left")
    rows = marked.mapInArrow(_report, "_id long, n_words long, n_removed long, kept_sha256 string")
    return rows.select(clean(F.col("_id")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


_WORD = re.compile(rb"[^ \t\n\r\x0b\x0c]+")


def cut_text(text: str, spans: list) -> str:
    """The text without the words of the spans and the white space after them."""
    data = text.encode()
    starts = [m.start() for m in _WORD.finditer(data)] + [len(data)]
    gone = _removed(len(starts) - 1, spans)
    kept = [data[: starts[0]], *[data[a:b] for a, b, g in zip(starts, starts[1:], gone, strict=False) if not g]]
    return b"".join(kept).decode()


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column("_whole").to_pylist(), batch.column("spans").to_pylist(), strict=True)
        texts = pa.array([cut_text(t, s) if s else t for t, s in rows], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("_row"), texts], ["_row", "_left"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """The documents with repeated passages cut out of ``text``; ``n_chars``, if there, follows. Rows stay,
    also those with nothing left."""
    spans = repeated_spans(docs, window, **options)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rows = docs.select(row.alias("_row"), F.col("text").alias("_whole"), *key_columns())
    given = rows.join(spans, ["_id", "_hash"], "left").select("_row", "_whole", "spans")
    cut = given.mapInArrow(_cut, f"_row {given.schema['_row'].dataType.simpleString()}, _left string")
    value = {"text": F.col("_left")}
    if "n_chars" in docs.columns:
        value["n_chars"] = F.length("_left").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[value.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
