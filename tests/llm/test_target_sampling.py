"""Resampling towards a target distribution against a plain version."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pagesmith.llm.queries import QUERIES
from pagesmith.llm.target_sampling import Hasher, target_sample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def windows(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return words, [zlib.crc32(w.encode()) % 10_000 for w in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]]


def plain(docs, items):
    source, target = [0] * 10_000, [0] * 10_000
    cut = [(key, *windows(text)) for key, text in docs]
    for _, _, found in cut:
        for b in found:
            source[b] += 1
    for text in items:
        for b in windows(text)[1]:
            target[b] += 1
    s_all, t_all = sum(source), sum(target)
    gain = [math.floor(1000 * math.log((t + 1) * (s_all + 10_000) / ((s + 1) * (t_all + 10_000)))) for s, t in zip(source, target)]
    rows, fit = [], []
    for i, (key, words, found) in enumerate(cut):
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None])
        if len(words) >= 20:
            fit.append(i)
    fit.sort(key=lambda i: (-rows[i][3], rows[i][0] is not None, rows[i][0] or 0))
    for rank, i in enumerate(fit[: 25 * len(fit) // 100], 1):
        rows[i][4] = rank
    return sorted(map(tuple, rows), key=str)


def got(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_plain_version(spark, sf):
    folder = f"/root/testdata/{sf}"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert got(QUERIES["op12_target_resampling"](spark, folder)) == plain(docs, items)


def test_odd_rows(spark):
    rng = random.Random(5)
    words = [*"abcdefgh", "É", "é", "中文", "😀", "x" * 63, "y" * 64, "Z" * 5000, "İ", "K"]
    text = lambda n: " ,\n\t!".join([]) + rng.choice([" ", ". ", "\n\n"]).join(rng.choice(words) for _ in range(n))
    rows = [(i, text(rng.randrange(40))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "123 ... 456"), (None, text(30)), (103, text(60_000)), (104, "\x00a\x7fb\u0080c")]
    rows += [(105, text(25))] * 3 + [(106, " ".join("same" for _ in range(19))), (107, " ".join("same" for _ in range(20)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(9) for c in ("row", "features", "score", "place", "p")})
    items = ["a b c É", None, "", text(50)]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    assert got(target_sample(docs, target)) == plain(rows, items)
    assert got(target_sample(docs, target.limit(0))) == plain(rows, [])
    assert got(target_sample(docs.limit(0), target)) == []


def test_ranks_are_gapless_over_many_partitions(spark):
    rows = [(i % 700, " ".join(f"w{i % 7}" for _ in range(20))) for i in range(2100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(13)
    found = got(target_sample(docs, docs.limit(5).select("text")))
    drawn = sorted((r for r in found if r[4] is not None), key=lambda r: r[4])
    assert [r[4] for r in drawn] == list(range(1, 526))
    assert drawn == sorted(drawn, key=lambda r: (-r[3], r[0], r[4])) and min(r[3] for r in drawn) >= max(r[3] for r in found if r[4] is None)


def test_pairs_by_tables():
    rng = random.Random(2)
    words = ["".join(rng.choice("abc0é中😀") for _ in range(rng.randrange(1, 80))) for _ in range(400)]
    want = [zlib.crc32(w.encode()) % 10_000 for w in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]]
    assert Hasher().windows(words).tolist() == want
