"""Resampling, trie counts and archives against plain versions."""

import base64
import hashlib
import io
import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pagesmith.llm import arc_warc as A
from pagesmith.llm.importance import kth_largest, resample
from pagesmith.llm.ngram_models import BUCKETS, SCALE, trusted_ids, weights, word_bucket
from pagesmith.llm.queries import QUERIES
from pagesmith.llm.trie_counts import LONG, MARK, PieceTrie, PrefixTrie, read_pieces, token_counts

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def plain_weights(docs, trusted):
    target, raw = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    grams = {}
    for key, text in docs:
        one = [word_bucket(w) for w in (text or "").encode().split()]
        grams[key] = one + [BUCKETS + (a * 31 + b) % BUCKETS for a, b in zip(one, one[1:], strict=False)]
        for g in grams[key]:
            raw[g] += 1
            target[g] += key in trusted
    fitted = weights(target, raw)
    return {k: sum(int(fitted[g]) for g in v) / SCALE for k, v in grams.items()}


def test_sample_is_the_largest_keys(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op3_importance_resampling"](spark, SF).collect()
    trusted = {r.doc_id for r in trusted_ids(labels).collect()}
    want = plain_weights([tuple(r) for r in docs.select("doc_id", "text").collect()], trusted)
    assert {r.doc_id: r.log_weight for r in rows} == want
    noise = np.array([r.sample_key - r.log_weight for r in rows])
    assert abs(noise.mean() - 0.577) < 0.4 and len(set(noise)) == len(rows)
    ranked = sorted(rows, key=lambda r: -r.sample_key)
    assert {r.doc_id for r in rows if r.kept} == {r.doc_id for r in ranked[: math.ceil(0.85 * len(rows))]}


def test_sample_leaves_junk_out(spark):
    sf = "/root/testdata/sf0.01"
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    seen = QUERIES["op3_importance_resampling"](spark, sf).join(marks, "doc_id")
    share = {r.quality: r.s for r in seen.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert share[1] > 0.9 and share[0] < 0.5


def test_sample_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "x " * 70_000), (4, "y"), (4, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"kept": F.lit(1), "_id": F.lit("q")})
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (None, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    assert len(resample(docs, labels).collect()) == 6
    assert resample(docs.limit(0), labels).collect() == []
    even = resample(docs, labels.limit(0), share=0.5).collect()
    assert all(r.log_weight == 0 for r in even) and 3 <= sum(r.kept for r in even) <= 4


def test_kth_largest(spark):
    values = [5, 5, 5, 1 << 62, 7 << 40, 9, 0, (1 << 63) - 1]
    df = spark.createDataFrame([(v,) for v in values], "key long")
    ordered = sorted(values, reverse=True)
    for k in range(1, len(values) + 1):
        found, held = kth_largest(df, k)
        assert found == ordered[k - 1] and held == k - sum(v > found for v in values)


def plain_tokens(text, pieces, unknown):
    best = [(0.0, 0)] + [None] * len(text)
    for i in range(1, len(text) + 1):
        options = [(best[i - 1][0] + unknown, best[i - 1][1] + len(text[i - 1].encode()))]
        for j in range(max(0, i - 40), i):
            if text[j:i] in pieces:
                options.append((best[j][0] + pieces[text[j:i]], best[j][1] + 1))
        best[i] = max(options, key=lambda o: (o[0], -o[1]))
    return best[-1][1]


def test_token_counts_match_a_plain_search(spark):
    pieces = read_pieces(MODEL)
    unknown = PieceTrie(pieces).unknown
    assert max(map(len, pieces)) <= 40
    words, seen = 0, {}
    got = {r.doc_id: r for r in QUERIES["op7_token_counts"](spark, SF).collect()}
    for key, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        total = 0
        for w in (text or "").encode().split():
            w = w.decode()
            if w not in seen:
                seen[w] = plain_tokens(MARK + w, pieces, unknown)
            total, words = total + seen[w], words + 1
        assert got[key].n_tokens == total, key
    assert sum(r.n_words for r in got.values()) == words


def test_trie_bounds_change_nothing():
    pieces = PieceTrie(read_pieces(MODEL))
    small, large = PrefixTrie(pieces, nodes=20, long=6), PrefixTrie(pieces)
    for word in ["the", "them", "theme", "日本語", "x" * LONG, "x" * 500, "é", "themes", "a▁b", "𝔘𝔫"] * 2:
        assert small.tokens(word.encode()) == large.tokens(word.encode()) == large.plain(MARK + word)


def test_token_counts_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, None), (1, " \n"), (2, "a"), (2, "a")], "doc_id long, text string").withColumn("n_words", F.lit(1))
    assert sorted((r.n_words, r.n_tokens) for r in token_counts(docs, MODEL).collect()) == [(0, 0), (0, 0), (1, 1), (1, 1)]
    assert token_counts(docs.limit(0), MODEL).collect() == []


def plain_archive(rows):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    last = {}
    for key, _, html in rows:
        last[digest(html)] = max(key, last.get(digest(html), key))
    return sorted((k, len((h or "").encode()), digest(h), "response" if last[digest(h)] == k else "revisit",
                   -1 if last[digest(h)] == k else last[digest(h)]) for k, _, h in rows)


def archived(df):
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to) for r in df.collect())


def test_archives_match(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert archived(QUERIES["op6_arc_to_warc"](spark, SF)) == plain_archive(rows)


def test_archives_of_odd_rows(spark):
    rows = [(1, None, None), (2, "http://a/b c\nd", ""), (3, "u", "x\r\n\r\ny"), (4, "u", "é" * 300_000), (5, "v", "x\r\n\r\ny"), (-6, "w", "HTTP/1.1 ")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"file": F.lit(1), "digest": F.lit(2)})
    assert archived(A.archive_round_trip(pages)) == plain_archive(rows)
    assert A.archive_round_trip(pages.limit(0)).collect() == []
    twice = spark.createDataFrame([(7, "u", "t"), (7, "u", "t"), (None, "u", "t")], "page_id long, url string, html string")
    assert sorted(r.record_type for r in A.archive_round_trip(twice).collect()) == ["response", "revisit", "revisit"]
    assert {r.record_type for r in A.archive_round_trip(pages, least_bytes=10**9).collect()} == {"response"}


@pytest.mark.parametrize("version", [b"1", b"2"])
def test_arc_lines_by_version(version):
    record = A.ArcRecord(b"http://x/a b", b"1.2.3.4", b"19970203", b"text/html", b"404", b"HTTP/1.0 404 No\r\n\r\nbody\nmore\n")
    data = A.gzip_member(A.arc_version_block("f.arc", version, b"1997")) + A.gzip_member(A.arc_record(record, version, "f.arc", 9))
    members = A.Members(io.BytesIO(data), piece=7)
    fields = A.arc_fields(members.read()[1])
    offset, raw = members.read()
    got = A.parse_arc_record(raw, fields)
    assert got == record._replace(url=b"http://x/a%20b", status=record.status if version == b"2" else b"-")
    assert members.read() is None
    members.seek(offset)
    assert members.read()[1] == raw
    assert A.parse_arc_record(raw.replace(b"%20", b" ", 1), fields).url == b"http://x/a b"
    head, block = A.parse_warc(A.to_warc(got, A.record_id("f.arc", offset)))
    assert head["warc-type"] == "response" and head["warc-date"] == "1997-02-03T00:00:00Z" and block == record.block
    with pytest.raises(ValueError):
        A.parse_arc_record(raw[:-20], fields)
    dns = A.to_warc(record._replace(block=b"20200101\nx A 1.2.3.4", mime=b"text/dns"), "<i>")
    assert A.parse_warc(dns)[0]["warc-type"] == "resource"
