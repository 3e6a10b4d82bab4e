"""SimHash components against a plain version that compares all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pagesmith.llm.components import components
from pagesmith.llm.queries import QUERIES
from pagesmith.llm.simhash import fingerprint_links, simhash_components


def plain(rows):
    def mark(text):
        words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    marks = [mark(t) for _, t in rows]
    distinct = sorted(set(marks))
    group = {m: m for m in distinct}

    def find(m):
        while group[m] != m:
            m = group[m]
        return m

    codes = np.array(distinct, np.uint64)
    for i, m in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(codes[i + 1 :] ^ codes[i]) <= 2):
            a, b = find(m), find(distinct[i + 1 + j])
            group[max(a, b)] = min(a, b)
    least = {}
    for (d, _), m in zip(rows, marks, strict=True):
        key = -(2**63) if d is None else d
        least[find(m)] = min(key, least.get(find(m), key))
    return sorted(
        (str(d), f"{m:016x}", str(None if least[find(m)] == -(2**63) else least[find(m)]))
        for (d, _), m in zip(rows, marks, strict=True))


def found(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def test_documents_match_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op8_simhash"](spark, sf)) == plain(rows)


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (None, " \n"), (7, "one"), (8, "One"), (8, "One"), (9, "a b"), (10, "word " * 50_000),
            (None, "x y z w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"_id": F.lit("x"), "fp": F.lit(1), "component": F.lit(2)})
    assert found(simhash_components(docs)) == plain(rows)
    assert simhash_components(docs.limit(0)).collect() == []


@pytest.mark.parametrize("tile", [3, 50, 100_000])
def test_links_connect_what_all_pairs_connect(spark, tile):
    rng = random.Random(tile)
    codes = {0, 3, (1 << 64) - 1}
    for _ in range(60):
        code = rng.getrandbits(64) if rng.random() < 0.5 else rng.choice(sorted(codes))
        for _ in range(rng.randint(1, 5)):
            code ^= 1 << rng.randrange(64)
            if rng.random() < 0.7:
                code ^= 1 << rng.randrange(64)
            codes.add(code)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fp long")
    roots = {r.node: r.root for r in components(fingerprint_links(df, 2, tile)).collect()}
    group = {c: c for c in signed}

    def find(c):
        while group[c] != c:
            c = group[c]
        return c

    for a in signed:
        for b in signed:
            if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2:
                x, y = find(a), find(b)
                group[max(x, y)] = min(x, y)
    assert {c: roots.get(c, c) for c in signed} == {c: find(c) for c in signed}


def test_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)], "u long, v long")
    assert {r.root for r in components(edges).collect()} == {0}
