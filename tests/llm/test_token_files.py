"""Token files and packing against the library's own encoding."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagesmith.llm.encode import Encoder
from pagesmith.llm.packing import BLOCK, Packer, best_cuts, candidate_cuts, pack, split_tail
from pagesmith.llm.queries import QUERIES
from pagesmith.llm.token_files import PlaneReader, PlaneWriter, from_planes, to_planes, token_round_trip

SF = "/root/testdata/sf0.001"
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def written(rows):
    tokenizer, start, out = Tokenizer.from_file(BYTE), 0, []
    for key, text in sorted(rows):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_files_hold_every_document(spark):
    got = sorted(map(tuple, QUERIES["op4_token_files"](spark, SF).collect()))
    assert got == written(documents(spark))


def test_files_of_odd_rows(spark):
    rows = [(3, None), (1, ""), (2, "a  b \n\n c"), (2, "z"), (2, "z"), (7, "long " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"file": F.lit(1), "_id": F.lit(2)})
    got = sorted(tuple(r)[1:3] for r in token_round_trip(docs, BYTE).collect())
    sizes = [len(Tokenizer.from_file(BYTE).encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows]
    assert sum(n for _, n in got) == sum(sizes) and got[0][0] == 0
    assert all(a + n == b for (a, n), (b, _) in zip(got, got[1:], strict=False))
    assert token_round_trip(docs.limit(0), BYTE).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=70), max_size=8), st.booleans())
def test_planes_round_trip(docs, bits):
    sink = io.BytesIO()
    sink.close = lambda: None
    writer = PlaneWriter(sink, bits, chunk=16)
    for key, ids in enumerate(docs):
        writer.add(key, np.array(ids, np.uint32))
    writer.close()
    source = io.BytesIO(sink.getvalue())
    source.size = lambda: len(sink.getvalue())
    assert [(k, i.tolist()) for k, i in PlaneReader(source).documents()] == list(enumerate(docs))
    flat = np.array([i for d in docs for i in d], np.uint32)
    assert from_planes(to_planes(flat, bits), len(flat), bits).tolist() == flat.tolist()


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_stretches_give_the_librarys_ids(spark, path):
    odd = ["", " ", "a  b", "a   b", "foo\n bar", " lead x", "it's 's x", "don 't", "x  y", "café é x", "a ́b",
           "<|endoftext|> x <|endoftext|>,", "日本 語 x", "tab\t x", "A.B ,c", "I'LL go!?", "ΑΣ Σ", "é. x"]
    encoder = Encoder(path, bound=500)
    texts = odd + [t for _, t in documents(spark)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == encoder.plain(text).tolist(), text[:80]
    assert [i.tolist() for i in encoder.encode(["", ""])] == [[], []]


def check_pieces(pieces, texts, size=2048):
    """Every id once, gapless sequences, the library's ids in every piece; returns the padding's share."""
    tokenizer = Tokenizer.from_file(WORD)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(texts)
    for key, own in by_doc.items():
        ids, at = tokenizer.encode(texts[key] or "", add_special_tokens=False).ids + [1], 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == crc(ids[at : at + p.length])
            at += p.length
        assert at == len(ids)
    padding = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding / sum(p.length for p in pieces)


def test_packing_keeps_every_id(spark):
    pieces = QUERIES["op10_packing"](spark, SF).collect()
    assert check_pieces(pieces, dict(documents(spark))) < 0.02


def test_packing_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "one"), (4, "word " * 30_000), (5, "a. " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"start": F.lit(1), "offset": F.lit("x")})
    assert check_pieces(pack(docs, WORD).collect(), dict(rows)) < 0.05
    assert pack(docs.limit(0), WORD).collect() == []
    twice = pack(spark.createDataFrame([(1, "x y"), (1, "x y"), (None, None)], "doc_id long, text string"), WORD).collect()
    assert sum(p.length for p in twice) == 7 and sum(p.start == 0 for p in twice) == 3


def plain_cuts(places, costs, size):
    whole, cost = [0, *places], [0, *costs]
    best = [0] + [None] * len(places)
    for j in range(1, len(whole)):
        for i in range(j):
            n = whole[j] - whole[i]
            if n > size:
                continue
            padding = 0 if n == size or (n & (n - 1) == 0 and n >= 256) else size - n
            value = best[i] + padding + cost[j] + 2
            best[j] = value if best[j] is None else min(best[j], value)
    return best[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 900), min_size=1, max_size=25), st.data())
def test_cuts_are_the_cheapest(steps, data):
    places = np.cumsum(steps)
    costs = np.array(data.draw(st.lists(st.sampled_from([0, 1, 24]), min_size=len(steps), max_size=len(steps))))
    cuts = best_cuts(places, costs, 1024)
    value, before = 0, 0
    for c in cuts:
        n = c - before
        assert 0 < n <= 1024
        value += (0 if n == 1024 or (n & (n - 1) == 0 and n >= 256) else 1024 - n) + 2 + costs[list(places).index(c)]
        before = c
    assert cuts[-1] == places[-1] and value == plain_cuts(places.tolist(), costs.tolist(), 1024)


def test_grid_reaches_everywhere():
    places, costs = candidate_cuts(np.array([10_000]), np.array([100, 5000]), 10_000)
    assert np.diff(places).max() <= 64 and places[-1] == 10_000 and costs[-1] == 0
    assert split_tail(1024) == [1024] and split_tail(1536) == [1024, 512] and split_tail(2047) == [2047]


def test_blocks_lose_nothing():
    packer, got = Packer(np.arange(50) % 7 == 0, block=5000), []
    docs = [np.arange(n, dtype=np.uint32) % 50 for n in (3, 12_000, 1, 4999, 7000, 20)]
    for key, ids in enumerate(docs):
        got += packer.add(key, ids)
    got += packer.rest()
    assert sum(p[2] for p in got) == sum(map(len, docs)) and BLOCK > 5000
    for key, start, length, code, total, _, _ in got:
        assert code == crc(docs[key][start : start + length]) and total == len(docs[key])


def unlike(path, texts):
    """The texts whose ids aren't the library's."""
    library = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    return [t for t, ids, want in zip(texts, Encoder(path).encode(texts), library, strict=True) if ids.tolist() != want.ids]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_every_character_beside_marks_and_spaces(path):
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    for form in ("GEZ{c}, ve{c}. {c}! x{c}? {c}; {c}:a", "{c} a{c}\n{c}b c", "a {c}, {c}{c}.\nb", "{c}"):
        texts = [form.replace("{c}", c) for c in chars]
        for i in range(0, len(texts), 16_384):
            assert unlike(path, texts[i : i + 16_384]) == []


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_random_mixtures(path):
    rng = random.Random(11)
    odd = "İıŞŁßſǅÅ\u0307\u0301\u0130\u212aΣς中😀\u00a0\u200b'1٣_-\t"
    parts = [*"aZéü", *odd, *",.!?;: \n", "GEZİ", "don't", "I'M", " the", "The ", "  ", "word", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(20_000)]
    assert unlike(path, texts) == []
    assert unlike(path, [" ".join(texts[:300]), "\n".join(texts[300:500])]) == []
