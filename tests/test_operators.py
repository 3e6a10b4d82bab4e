"""Operators on small fixtures: skew-safe joins, providers, storage, vectors, streaming."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagesmith.cluster import bounded_batches, cut_lineage, salted_lookup, settled
from pagesmith.functions.tokens import count_tokens, trim_to_tokens
from pagesmith.functions import html as H
from pagesmith.functions import replies
from pagesmith.operators import history, keyed, listings, page_rows, providers, runs, vectors
from pagesmith.operators.pricing import MAX_MODELS, price_runs, pricing_table
from pagesmith.plans import extract
from pagesmith.sources import frontier, pages as source


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_keeps_first_in_any_input_order(spark):
    data = [(1, 0, 0, "x", "1"), (1, 0, 1, "y", "2"), (1, 2, 0, "x", "1"), (2, 5, 3, "x", "1"), (2, 5, 1, "x", "1")]
    expected = [(1, 0, 0, "x", "1"), (1, 0, 1, "y", "2"), (2, 5, 1, "x", "1")]
    for seed in range(3):
        shuffled = random.Random(seed).sample(data, len(data))
        df = spark.createDataFrame(shuffled, "scrape_id int, chunk_idx int, pos int, `Product Name` string, p string")
        merged = listings.merge_listings(df.repartition(4), ["Product Name", "p"])
        assert rows(merged) == expected
        assert rows(listings.merge_listings(merged, ["Product Name", "p"])) == expected


def test_merge_with_large_positions(spark):
    data = [(1, 10**17, 10**18 - 1, "x"), (1, 10**17, 10**18 - 2, "x"), (1, 3, 2**40, "y")]
    df = spark.createDataFrame(data, "scrape_id int, chunk_idx bigint, pos bigint, a string")
    assert rows(listings.merge_listings(df, ["a"])) == [(1, 3, 2**40, "y"), (1, 10**17, 10**18 - 2, "x")]


def test_response_parts_split_long_runs(spark):
    data = [(1, c, p, f"{c}-{p}") for c in range(10) for p in range(3)]
    df = spark.createDataFrame(data, "scrape_id int, chunk_idx int, pos int, a string").repartition(5)
    parts = listings.response_parts(df, ["a"], chunks_per_part=4).orderBy("part").collect()
    assert [len(p["data"]) for p in parts] == [12, 12, 6]
    assert [d["a"] for p in parts for d in p["data"]] == [d[3] for d in data]


def test_salted_lookup_equals_plain_join(spark):
    facts = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    facts = facts.union(spark.sql("select 9999L, cast(null as bigint)"))
    records = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        got = salted_lookup(facts, records, "k", how).select("id", "k", "v")
        want = facts.join(records, "k", how).select("id", "k", "v")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_settled_keeps_the_result_alone(spark):
    before = cut_lineage(spark.range(5))
    inner = []

    def make():
        inner.append(cut_lineage(before.where("id > 1")))
        inner.append(settled(lambda: cut_lineage(inner[0].select((F.col("id") * 2).alias("id"))).where("id < 8")))
        return inner[0].union(inner[1])

    kept = settled(make)
    assert rows(kept) == rows(kept) == [(2,), (3,), (4,), (4,), (6,)] and before.count() == 5
    for gone in inner:
        with pytest.raises(Exception, match="(?i)not.*exist"):
            gone.count()
    with pytest.raises(ValueError):
        settled(lambda: (_ for _ in ()).throw(ValueError()))
    assert cut_lineage(before).count() == 5


def test_consecutive_numbers(spark):
    ids = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(i,) for i in ids], "k int").repartition(6)
    got = rows(keyed.consecutive_numbers(df, "k", "n").select("n", "k"))
    assert got == list(enumerate(sorted(ids), 1))


def test_append_to_empty_table_starts_at_one(spark):
    items = spark.createDataFrame([], "id bigint, name string, description string")
    new = spark.createDataFrame([(3, "c", "x"), (1, "a", None), (2, None, "y")], "n int, name string, description string")
    good, bad = keyed.append(items, new, "n")
    assert sorted((r["id"], r["name"]) for r in good.collect()) == [(1, "a"), (2, "c")]
    assert [r["n"] for r in bad.collect()] == [2]


def test_provider_failures_are_rows(spark):
    def provider(prompt):
        if "bad" in prompt:
            raise RuntimeError("no answer")
        return '{"listings":[{"a":"' + prompt[-1] + '"}]}', 3, 2

    prompts = spark.createDataFrame([(1, 0, "p1"), (1, 1, "bad"), (1, 2, "p3")], "scrape_id int, chunk_idx int, prompt string")
    parsed = cut_lineage(listings.parse_replies(providers.call_provider(prompts, provider, tasks=2), ["a"]))
    assert rows(listings.failed_chunks(parsed)) == [(1, 1, "failed", "RuntimeError: no answer")]
    assert rows(listings.flatten_listings(parsed, ["a"])) == [(1, 0, 0, "1"), (1, 2, 0, "3")]
    assert rows(listings.token_totals(parsed)) == [(1, 6, 4)]


def test_array_fields(spark):
    data = [(1, 0, '{"listings":[{"n":"x","tags":["a","b"]},{"n":"y"}]}', 1, 1, None)]
    df = spark.createDataFrame(data, "scrape_id int, chunk_idx int, reply string, input_tokens int, output_tokens int, error string")
    parsed = listings.fill_listings(listings.parse_replies(df, ["n", "tags"], arrays=["tags"]), ["n", "tags"], ["tags"])
    got = sorted(tuple(r)[3:] for r in listings.merge_listings(listings.flatten_listings(parsed, ["n", "tags"]), ["n", "tags"]).collect())
    assert got == [("x", ["a", "b"]), ("y", [])]


def test_known_replies_are_not_asked_again(spark):
    prompts = spark.createDataFrame([("p", "m"), ("p", "m"), ("q", "m"), ("p", "n")], "prompt string, model string")
    stored = prompts.limit(1).select(F.sha2("prompt", 256).alias("prompt_hash"), "model", F.lit("r").alias("reply"))
    answered, open_ = providers.split_known(prompts, stored)
    assert answered.count() == 2
    assert rows(open_.select("prompt", "model")) == [("p", "n"), ("q", "m")]


def test_pair_rule(spark):
    df = spark.createDataFrame([("Name: Pen\n* price : 3 \nother",), ("nothing",)], "t string")
    got = [r[0] for r in df.select(providers.pair_rule_reply(F.col("t"), ["Name", "Price", "Size"])).collect()]
    assert got == ['{"listings":[{"Name":"Pen","Price":"3"}]}', '{"listings":[]}']


def test_tokens(spark):
    got = spark.sql("select 'abcde' t").select(count_tokens(F.col("t")), trim_to_tokens(F.col("t"), 1), trim_to_tokens(F.col("t"), 2)).first()
    assert tuple(got) == (2, "abcd", "abcde")


def test_prices(spark):
    df = spark.createDataFrame([("gpt-4o-mini", 1000, None), ("nope", 1, 1)], "model string, input_tokens bigint, output_tokens bigint")
    good, bad = price_runs(df, pricing_table(spark))
    assert float(good.first()["cost"]) == 0.00015
    assert bad.first()["reason"] == "unsupported_model"
    with pytest.raises(ValueError):
        pricing_table(spark, [(str(i), "1", "1") for i in range(MAX_MODELS + 1)])


def test_requests_are_checked_in_order(spark):
    data = [("", ["a"], None), ("ftp://x.example.com", ["a"], None), ("https://x.example.com", [], None),
            ("https://x.example.com", ["a"], "nope"), ("https://x.example.com", ["a"], None)]
    good, bad = frontier.check_requests(spark.createDataFrame(data, "url string, fields array<string>, model string"), pricing_table(spark))
    assert [r["model"] for r in good.collect()] == [frontier.DEFAULT_MODEL]
    assert sorted(r["reason"] for r in bad.collect()) == ["no_fields", "unsupported_model", "url_bad_scheme", "url_empty"]


def test_page_status(spark):
    data = [(1, "u", "h", 200), (2, "u", None, 200), (3, "u", "h", 404), (4, "u", "h", None)]
    good, bad = source.split_by_status(spark.createDataFrame(data, "page_id int, url string, html string, status int"))
    assert [r["page_id"] for r in good.collect()] == [1]
    assert sorted((r["page_id"], r["reason"]) for r in bad.collect()) == [(2, "no_response"), (3, "http_404"), (4, "no_response")]


def test_text_files_one_per_row_without_a_commit_per_file(spark, tmp_path):
    texts = ["a", "a", None, "", "é\nz"] + [f"<p>{i}</p>" for i in range(10_000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(8)
    import time

    began = time.time()
    runs.write_texts(df, str(tmp_path / "out"))
    took = time.time() - began
    files = sorted((tmp_path / "out").iterdir())
    assert all(f.name.endswith(".txt") for f in files) and len(files) == len(texts)
    assert sorted(f.read_bytes() for f in files) == sorted((t or "").encode() + b"\n" for t in texts)
    # Spark's text writer with one record a file took some 3 ms a file here (about 30 s)
    assert took < 15, took
    read = spark.read.text(str(tmp_path / "out"), wholetext=True).count()
    assert read == len(texts)


def test_html_dir_skips_other_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>1</p>\n<p>2</p>")
    (tmp_path / "b.md").write_text("no")
    assert [r["html"] for r in source.scan_html_dir(spark, str(tmp_path)).collect()] == ["<p>1</p>\n<p>2</p>"]


def _run_tables(spark):
    at = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    meta = spark.range(4).select("id", F.lit("u").alias("url"), (at + F.make_dt_interval(hours=F.col("id").cast("int") * 12)).alias("timestamp"), F.lit("m").alias("model_used"))
    meta = meta.withColumn("run_date", F.to_date("timestamp"))
    child = meta.select(F.col("id").alias("scrape_id"), "run_date")
    data = child.withColumn("data", F.lit('{"a":"1"}'))
    cost = child.withColumns({"input_tokens": F.lit(1), "output_tokens": F.lit(2), "total_cost": F.lit(0.5)})
    return meta, data, cost


def test_storing_twice_changes_nothing(spark, tmp_path):
    for _ in range(2):
        runs.store_runs(str(tmp_path), "b1", *_run_tables(spark))
    meta, data, cost = runs.read_runs(spark, str(tmp_path))
    assert (meta.count(), data.count(), cost.count()) == (4, 4, 4)
    assert runs.orphans(data, meta.where("id <> 2")).collect()[0]["scrape_id"] == 2
    assert history.listings_of_run(data, 3).first()["record"] == {"a": "1"}


def test_end_day_is_excluded(spark, tmp_path):
    runs.store_runs(str(tmp_path), "b1", *_run_tables(spark))
    meta, _, cost = runs.read_runs(spark, str(tmp_path))
    ids = lambda **kw: [r["id"] for r in history.retrieve_runs(meta, cost, **kw).collect()]
    assert ids() == [3, 2, 1, 0]
    assert ids(end_date="2024-01-03") == [1, 0]
    assert ids(end_date="2024-01-03", end_inclusive=True) == [3, 2, 1, 0]
    assert ids(start_date="2024-01-03", limit=1) == [3]
    plan = history.retrieve_runs(meta, cost, start_date="2024-01-03")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(run_date") == 2 and "TakeOrderedAndProject" in plan


def test_vector_topk_paths_agree_with_brute_force(spark):
    rng = np.random.default_rng(3)
    v = rng.integers(0, 4, (300, 5)).astype(float)  # many equal distances
    q = rng.integers(0, 4, (23, 5)).astype(float)
    vdf = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>").repartition(4)
    qdf = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "question_id bigint, embedding array<double>")
    want = []
    for i, x in enumerate(q):
        best = sorted((((v - x) ** 2).sum(1)[j], j) for j in range(len(v)))[:4]
        want += [(i, r + 1, j, d) for r, (d, j) in enumerate(best)]
    assert rows(vectors.vector_topk(vdf, qdf)) == want
    assert rows(vectors.vector_topk(vdf, qdf, max_shared=5, block=70)) == want
    assert vectors.vector_topk(vdf, qdf.limit(0)).count() == 0


def test_long_documents_come_in_parts(spark):
    df = spark.createDataFrame([(1, i, str(i % 10)) for i in range(25)], "d int, page int, text string").repartition(5)
    parts = [r["text"] for r in vectors.concat_pages(df, "d", "page", pages_per_part=10).orderBy("part").collect()]
    assert parts == ["0123456789", "0123456789", "01234"]


def test_extraction_options(spark):
    html = '<body><p><a href="https://a.example.com/x">X</a> ' + "word " * 300 + '<a href="/y">Y</a></p></body>'
    pages = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    small = extract.Options(chunk_size=200, chunk_overlap=20)
    result = extract.extract_pages(pages, ["t", "h"], "gpt-4o-mini", pricing_table(spark), options=small)
    assert result.totals.first()["n_chunks"] > 5
    assert rows(result.listings.select("t", "h")) == [("X", "https://a.example.com/x"), ("Y", "/y")]
    dropped = extract.page_markdown(pages, extract.Options(drop_urls=True)).first()["text"]
    assert "https" not in dropped
    assert len(extract.page_markdown(pages, extract.Options(max_tokens=10)).first()["text"]) == 40
    unknown = extract.extract_pages(pages, ["t", "h"], "nope", pricing_table(spark))
    assert unknown.totals.count() == 0 and unknown.unpriced.count() == 1


def test_arrivals(spark, tmp_path):
    from pagesmith.streaming.arrivals import extract_arrivals, read_arrivals

    source_dir, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    for batch in range(2):
        page = [(batch, "u", f'<a href="/{batch}">n{batch}</a>')]
        spark.createDataFrame(page, "page_id bigint, url string, html string").write.mode("append").parquet(source_dir)
        query = extract_arrivals(read_arrivals(spark, source_dir), out, ckpt, ["t", "h"], "chatgpt", pricing_table(spark))
        query.awaitTermination(120)
    data = spark.read.parquet(out).select("scrape_id", "data")
    assert rows(data) == [(0, '{"t":"n0","h":"/0"}'), (1, '{"t":"n1","h":"/1"}')]


def test_nested_matches_keep_their_own_ends(spark):
    html = '<nav class="m"><a href="/1">a</a><nav class="m"><a href="/1.1">b</a></nav><a href="/2">c</a></nav><li class="m">x<li class="m">y'
    df = spark.createDataFrame([(html,)], "html string")
    found = df.select(H.find_elements(F.col("html"), None, "m").alias("e")).first().e
    assert [x.count("<a ") for x in found] == [3, 1, 0, 0] and found[2].endswith(">x")


def test_repeated_headers_fail_no_page(spark):
    html = '<table id="t"><tr><th></th><th></th><th>h</th></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>'
    good, bad, _ = page_rows.table_rows(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"), "t")
    assert rows(page_rows.widen(good, ["", "h"])) == [(1, 1, "1", "3")] and bad.count() == 0


def test_update_takes_the_last_value_of_each_column(spark):
    items = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, name string, price double")
    changes = spark.createDataFrame([(1, "x", None, 1), (1, "y", 5.0, 2), (1, None, None, 3)], "id long, name string, price double, at int")
    assert rows(keyed.update(items, changes, ["name", "price"], "at")[0]) == [(1, "y", 5.0), (2, "b", 2.0)]


def test_numbers_of_hashed_keys(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("k"))
    got = keyed.consecutive_numbers(df, "k", "n").orderBy("k").select("n")
    assert [r.n for r in got.collect()] == list(range(1, 1001))


def test_batches_of_a_day_are_kept(spark, tmp_path):
    def batch(name, *ids):
        made = spark.createDataFrame([(str(i), "2024-01-01") for i in ids], "id string, run_date string")
        child = made.withColumnRenamed("id", "scrape_id")
        runs.store_runs(str(tmp_path), name, made, child, child)

    batch("a", 1, 2)
    batch("b", 3)
    batch("a", 2)
    assert [sorted(r[0] for r in t.select(t.columns[0]).collect()) for t in runs.read_runs(spark, str(tmp_path))] == [["2", "3"]] * 3


def test_replies_with_repeated_keys_or_tails(spark):
    cases = {'{"listings":[{"a":"1","a":"2"}],"listings":[]}': "ok", "[1]": "no_object", '{"a":1} x': "invalid", '{"a":1}]': "invalid",
             '{"a":1}}': "invalid", "1,2": "invalid", "": "invalid", '{"listings":[{"a":"' + "x" * 9_000_000 + '"}]}': "ok"}
    df = spark.createDataFrame([(k,) for k in cases], "reply string")
    got = df.select("reply", replies.parse_reply(F.col("reply"), ["a"]).alias("p")).collect()
    assert {r.reply: r.p.status for r in got} == cases
    assert [len(r.p.listings) for r in got if len(r.reply) > 1000] == [1]


def test_nearest_of_equal_and_huge_vectors():
    import numpy as np

    vecs = np.ones((20_000, 8))
    vecs[7] *= 1e6
    ids = np.arange(20_000)[::-1].copy()
    found = vectors._nearest(np.arange(40), np.ones((40, 8)), ids, vecs, 3)
    assert found.groupby("question_id")["vec_id"].apply(list).tolist() == [[0, 1, 2]] * 40


def test_texts_without_words_have_zero_vectors(spark):
    df = spark.createDataFrame([(1, "!?"), (2, None), (3, "über ÜBER"), (4, "日本")], "id long, text string")
    got = {r.id: r.embedding for r in vectors.embedded(df, "id").collect()}
    assert not any(got[1]) and not any(got[2]) and max(got[3]) == max(got[4]) == 1.0


def test_bounded_batches_keep_the_sessions_own_setting(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    try:
        spark.conf.set(name, "3m")
        bounded_batches(spark)
        assert spark.conf.get(name) == "3m"
        spark.conf.unset(name)
        bounded_batches(spark, "1k")
        assert spark.conf.get(name) == "1k"
        sizes = spark.range(3000, numPartitions=1).mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"n": [len(b)]}) for b in batches), "n long").collect()
        assert sum(r.n for r in sizes) == 3000 and max(r.n for r in sizes) < 1000
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
