"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are worked out per document, equal ones become one, and the distinct ones are dealt into
tiles by the bit counts of their four 16-bit quarters. Two fingerprints within the radius lie in tiles
whose counts differ by the radius at most in sum, so all other pairs of tiles are skipped; the rest
are compared whole, with numpy's exclusive-or and bit counts. No link can be missed, nothing is capped:
a tile with too many fingerprints is cut into several, and each is compared with all it has to be.

Nulls and empty texts have the fingerprint zero and are linked like any other; texts with fewer words
than a shingle have one shingle of all their words; repeated rows share a component; other columns are
ignored; no documents give no rows. A null id takes part as an id smaller than all others and is
returned as null."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pagesmith.cluster import cut_lineage
from pagesmith.llm.common import clean, first_of_each, key_columns, keyed, whole_row
from pagesmith.llm.components import components

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Fingerprints in one tile.
TILE = 1 << 15
QUARTERS = 4
_BITS = 1 << 13


def fingerprint(words: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is one if more than half of the hashed shingles have bit i."""
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.zeros(len(words), np.int64)
    np.cumsum(lengths[:-1] + 1, out=starts[1:])
    first = starts[: len(words) - size + 1].tolist()
    last = (starts[size - 1 :] + lengths[size - 1 :]).tolist()
    hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(first, last, strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BITS):
        part = hashes[i : i + _BITS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.lower().split(), shingle, seed) for t in batch.column("_text").to_pylist()]
            prints = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_hash"), prints], ["_id", "_hash", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``_id, _hash, fp`` of every row; the texts aren't shuffled."""
    return keyed(docs).mapInArrow(_fingerprints(shingle, seed), "_id long, _hash long, fp long")


def _tile_of(fp):
    """Bit counts of the quarters, in one number (5 bits each)."""
    counts = [F.bit_count(F.shiftrightunsigned(fp, 16 * q).bitwiseAND(F.lit(0xFFFF))) for q in range(QUARTERS)]
    tile = counts[0].cast("int")
    for q in range(1, QUARTERS):
        tile = tile.bitwiseOR(F.shiftleft(counts[q].cast("int"), 5 * q))
    return tile


def _steps(radius: int) -> list[int]:
    """Differences of tile numbers for all pairs of tiles that aren't skipped: those whose quarters'
    counts differ by ``radius`` at most in all. A sum that leaves 0 to 16 in a quarter is no tile's number."""
    near = [s for s in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, s)) <= radius]
    return [sum(v << (5 * q) for q, v in enumerate(s)) for s in near]


def _plan(tiled: DataFrame, radius: int, size: int) -> DataFrame:
    """``tile, parts, unit, units``: the tiles whose fingerprints go to a tile's units, from the smaller
    tile to itself and its larger neighbours. There are 17 ** 4 = 83,521 tiles at most, however many
    documents there are."""
    tiles = tiled.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias("parts"))
    steps = F.explode(F.array(*[F.lit(s) for s in _steps(radius)])).alias("step")
    pairs = tiles.select("tile", "parts", steps).select("tile", "parts", (F.col("tile") - F.col("step")).alias("unit"))
    units = tiles.select(F.col("tile").alias("unit"), F.col("parts").alias("units"))
    return pairs.where("unit <= tile").join(units, "unit")


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same connections by fewer links: lowers each node to the smallest one it is linked with."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def _compare(radius: int, block: int = 1024):
    """Rows arrive sorted by unit; a unit's own fingerprints (role 0) come before its neighbours'.
    Holds one tile and one batch; what links a unit finds is cut down to a forest as it grows."""

    def links(own: np.ndarray, others: np.ndarray, within: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(own), block):
            mine = own[i : i + block, None]
            for j in range(i if within else 0, len(others), block):
                theirs = others[None, j : j + block]
                a, b = np.nonzero(np.bitwise_count(mine ^ theirs) <= radius)
                a, b = own[i + a], others[j + b]
                keep = a != b
                if keep.any():
                    yield _forest(a[keep], b[keep])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(pairs):
            u, v = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
            u, v = _forest(u, v)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        unit, own, compared, found, held = None, [], False, [], 0
        tile = np.zeros(0, np.uint64)
        for batch in batches:
            units = batch.column(0).to_numpy()
            roles = batch.column(1).to_numpy()
            prints = batch.column(2).to_numpy().view(np.uint64)
            cuts = np.flatnonzero((units[1:] != units[:-1]) | (roles[1:] != roles[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(units)], strict=True):
                if lo == hi:
                    continue
                if units[lo] != unit:
                    if own and not compared:
                        tile = np.concatenate(own)
                        found += links(tile, tile, True)
                    unit, own, compared = units[lo], [], False
                if roles[lo] == 0:
                    own.append(prints[lo:hi])
                    continue
                if not compared:
                    tile = np.concatenate(own) if own else np.zeros(0, np.uint64)
                    found += links(tile, tile, True)
                    compared = True
                found += links(tile, prints[lo:hi], False)
            held = sum(len(p[0]) for p in found)
            if held > 200_000:
                yield batch_of(found)
                found = []
        if own and not compared:
            tile = np.concatenate(own)
            found += links(tile, tile, True)
        if found:
            yield batch_of(found)

    return run


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links ``u, v`` that connect all distinct fingerprints (``fp``) within ``radius`` bits of each
    other. They connect the same fingerprints as all pairs would, but a group of g has some g links."""
    tiled = distinct.select("fp", _tile_of(F.col("fp")).alias("tile"))
    plan = cut_lineage(_plan(tiled, radius, tile))
    part = F.pmod(F.xxhash64("fp"), F.col("parts").cast("long")).cast("int")
    same = F.col("tile") == F.col("unit")
    dealt = tiled.join(F.broadcast(plan), "tile").select("fp", "unit", part.alias("part"), same.alias("same"), "units")
    last = F.when(F.col("same"), F.col("part")).otherwise(F.col("units") - 1)
    sent = dealt.select("fp", "unit", "part", "same", F.explode(F.sequence(F.lit(0), last)).alias("to"))
    rows = sent.select(
        (F.col("unit").cast("long") * F.lit(1 << 32) + F.col("to")).alias("unit"),
        F.when(F.col("same") & (F.col("part") == F.col("to")), 0).otherwise(1).alias("role"), "fp")
    ordered = rows.repartition("unit").sortWithinPartitions("unit", "role")
    return ordered.mapInArrow(_compare(radius), "u long, v long")


def near_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """``_id, _hash, fp, root, component`` of every row. ``root`` names the component; ``component`` is the smallest id
    reachable by links, which other components may hold, too, where ids repeat or are null."""
    prints = cut_lineage(fingerprints(docs, shingle, seed))
    distinct = prints.select("fp").distinct()
    roots = components(fingerprint_links(distinct, radius))
    least = prints.groupBy("fp").agg(F.min("_id").alias("least"))
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.select("fp", "root").join(smallest, "root")
    return prints.join(named, "fp").select("_id", "_hash", "fp", "root", "component")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    found = near_components(docs, shingle, radius, seed)
    return found.select(
        clean(F.col("_id")).alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        clean(F.col("component")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """One document of each component, all columns as they were: that with the smallest id, of rows that share
    this id the one with the smallest text hash, of repeated rows one."""
    first = first_of_each(near_components(docs, shingle, radius, seed))
    rows = docs.select(whole_row(docs), *key_columns())
    return rows.join(first, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"]).select("_row.*")
