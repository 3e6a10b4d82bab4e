"""URL filters, decontamination, quality rules and repeated passages on odd rows and by brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagesmith.llm import decontaminate as D
from pagesmith.llm.quality_rules import keep_good, quality_scores
from pagesmith.llm.substrings import SuffixAutomaton, cut_text, remove_repeats, repeat_report
from pagesmith.llm.url_filters import filter_urls, refused_rules

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("A.net", "/es/x", "allow"), ("b.net", "/e", "block"), ("b.net", "/e", "allow"), ("", "/", "block"), (None, None, "block")]


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = []
    for h, p, v in RULES:
        h = (h or "").lower()
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h) + len(p), len(h), v, h + p))
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_urls_by_brute_force(spark):
    urls = [None, "", "no scheme/en/", "http://example.com/en/1", "http://WWW.Example.com/en/?q", "x://example.com", "x://example.com?/en/",
            "http://notexample.com/en/", "http://a.net/es/x1", "http://q.a.net/es/", "http://b.net/ex#/y", "http://com/en/", "http://É.com/",
            "http://a://b.com/", "http://example.com:80/en/", "http://example.com./en/", "http://" + "a." * 3000 + "com/" + "y" * 5000, "://net/es/",
            "http://b.net/e\nn", "http://b.net/e\nn"]
    pages = spark.createDataFrame([(i if i else None, u) for i, u in enumerate(urls)], "page_id long, url string").withColumns(
        {"host": F.lit(1), "rule": F.lit("r"), "verdict": F.lit("v")})
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    want = sorted((str(i if i else None), *map(str, plain_verdict(u))) for i, u in enumerate(urls))
    for most in (1000, 0):
        got = sorted(tuple(map(str, r)) for r in filter_urls(pages, rules, broadcast_rules=most).select("page_id", "host", "path", "rule", "verdict").collect())
        assert got == want
    assert {r.verdict for r in filter_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert filter_urls(pages.limit(0), rules).collect() == []


def plain_leaks(docs, items, size=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    windows = {}
    for key, text in items:
        w = split(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(key)
    out = []
    for key, text in docs:
        w, hit, found = split(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[tuple(w[i : i + k])]
        names = sorted(str(f) for f in found if f is not None)
        out.append((str(key), len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def test_leaks_by_brute_force(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "B", "ç", "x1", "Zz"])
    items = [(1, None), (2, ""), (3, "-- !"), (4, "Solo"), (5, "a b x1"), (6, " ".join(word() for _ in range(12))), (7, "日本 語, É é"), (None, "null id"), (5, "a b x1")]
    docs = [(1, None), (2, ""), (3, "Solo-solo"), (4, "x " * 30_000 + "SOLO"), (5, items[5][1] + " tail"), (None, "null;ID"), (7, "日本 語 É é"), (7, "日本 語 É é")]
    docs += [(i, "\n".join(word() for _ in range(rng.randrange(40)))) for i in range(10, 40)]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"n_hit": F.lit(1), "words": F.lit(2), "_id": F.lit(3)})
    items_df = spark.createDataFrame(items, "item_id long, text string").withColumn("w", F.lit(1))
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    run = lambda d, i, **o: sorted((str(r[0]), *r[1:]) for r in D.contamination(d, i, **o).select(*columns).collect())
    want = plain_leaks(docs, items)
    assert run(docs_df, items_df) == want
    assert run(docs_df, items_df, round_size=4) == want
    assert not any(r[5] for r in run(docs_df, items_df.limit(0)))
    assert run(docs_df.limit(0), items_df) == []
    kept = D.drop_contaminated(docs_df, items_df)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(r[0] for r in want if not r[5]) and kept.columns == docs_df.columns
    cut = {r.doc_id: r.text for r in D.cut_contaminated(docs_df, items_df).where("doc_id < 10").collect()}
    assert cut[3] == "" and cut[5] == "tail" and cut[1] is None and cut[4].split()[-1] == "x"


def test_quality_of_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (2, ""), (None, text), (4, text), (4, text), (5, "a b c " * 20_000), (6, "l #1\nl #1\n \n \nl #1 é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_words": F.lit(1), "kept": F.lit(2), "_row": F.lit(3)})
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_scores(docs, labels).collect()
    last = [r for r in got if r.doc_id == 6][0]
    assert (last.n_words, last.word_chars, last.n_symbols, last.n_dup_lines, last.n_repeat_words) == (7, 10, 3, 1, 6)
    assert sorted(str(r.doc_id) for r in got if r.kept) == ["4", "4", "None"] and [r.n_repeat_words for r in got if r.doc_id == 5] == [60_000]
    assert quality_scores(docs.limit(0), labels).collect() == [] and len(quality_scores(docs, labels.limit(0)).collect()) == 7
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["4", "4", "None"]
    assert {r._row for r in kept.collect()} == {3}


def plain_repeats(docs, window):
    split = [(k, (t or "").encode().split()) for k, t in docs]
    counts = Counter(tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = []
    for key, w in split:
        gone = {p for i in range(len(w) - window + 1) if counts[tuple(w[i : i + window])] > 1 for p in range(i, i + window)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((str(key), len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("window", "gram", "hot", "words", "shard"), [(6, 2, 1000, 4, 50), (6, 2, 2, 3, 1), (9, 4, 2, 30, 20_000), (35, 8, 1, 2, 500)])
def test_repeats_by_brute_force(spark, window, gram, hot, words, shard):
    rng = random.Random(window + words)
    docs = [(1, None), (2, ""), (None, "short text"), (3, "w " * 200), (3, "w " * 200), (4, " ".join(f"z{i}" for i in range(40)))]
    passage = [" ".join(f"p{rng.randrange(words)}" for _ in range(50)) for _ in range(3)]
    for i in range(5, 40):
        parts = [" ".join(f"p{rng.randrange(words)}" for _ in range(rng.randrange(40))), rng.choice(passage), " ".join(f"q{rng.random()}" for _ in range(9))]
        rng.shuffle(parts)
        docs.append((i, "\n".join(parts)))
    docs += [(100, docs[-1][1]), (101, docs[-1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"first": F.lit(1), "spans": F.lit(2)})
    got = repeat_report(df, window, gram=gram, hot_pieces=hot, shard_words=shard)
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted((str(r[0]), *r[1:]) for r in got.select(*columns).collect()) == plain_repeats(docs, window)


def test_very_long_document_against_itself(spark):
    rng = random.Random(5)
    half = " ".join(str(rng.randrange(10**9)) for _ in range(60_000))
    docs = [(1, half + " x " + half), (2, half[: len(half) // 3])]
    got = repeat_report(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == plain_repeats(docs, 35)


def test_removal_keeps_rows_and_columns(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"Head,\n {passage}\n tail", 5, None), (2, passage, 6, "s"), (3, None, None, "s"), (4, "as  it was\n", 11, "s")],
                                 "doc_id long, text string, n_chars long, spans string")
    got = {r.doc_id: r for r in remove_repeats(docs).collect()}
    assert got[1].text == "Head,\n tail" and got[1].n_chars == 11 and got[2].text == "" and got[3].text is None
    assert got[4].text == "as  it was\n" and got[4].spans == "s" and remove_repeats(docs.limit(0)).columns == docs.columns
    assert cut_text(" a é  b ", [{"start": 1, "end": 2}]) == " a b "


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=14), st.integers(1, 2)), min_size=1, max_size=5))
def test_automaton_counts_occurrences(pieces):
    automaton = SuffixAutomaton()
    for words, copies in pieces:
        automaton.add(words, copies)
    automaton.settle()
    counts = Counter()
    for words, copies in pieces:
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                counts[tuple(words[i:j])] += copies
    for words, _ in pieces:
        want = [max([i - j for j in range(i) if counts[tuple(words[j:i])] > 1], default=0) for i in range(1, len(words) + 1)]
        assert automaton.matches(words) == want


def test_refused_rules(spark):
    rows = [("a.com", "/", "allow"), ("", "/", "block"), (None, "/", "block"), ("a.com", "", "block"), ("a.com", None, "allow"),
            ("a.com", "/x", "deny"), ("a.com", "/y", None), ("b.com", "/", "block")]
    rules = spark.createDataFrame(rows, "host string, path string, verdict string")
    assert sorted(map(str, map(tuple, refused_rules(rules).collect()))) == sorted(map(str, rows[1:-1]))
    assert refused_rules(rules.limit(0)).collect() == []
