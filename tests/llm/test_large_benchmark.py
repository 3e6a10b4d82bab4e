"""Decontamination by a benchmark with more windows than travel with a plan."""


from pagesmith.llm import decontaminate as D
from tests.llm.test_filters import plain_leaks

SF = "/root/testdata/sf0.001"


def test_large_benchmark_is_joined(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    short = spark.createDataFrame([(9001, "the of"), (9002, "is"), (None, "the of and"), (9003, "")], "item_id long, text string")
    items = items.select("item_id", "text").union(short)
    docs = docs.select("doc_id", "text").union(docs.select("doc_id", "text").where("doc_id < 3"))
    want = plain_leaks([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    n_keys, n_rows = D.item_windows(items).select("k", "h").distinct().count(), []
    assert n_keys > 20
    for name in ("collect", "toLocalIterator"):
        whole = getattr(type(docs), name)
        monkeypatch.setattr(type(docs), name, lambda self, *a, f=whole: n_rows.append(self.count()) or f(self, *a))
    got = D.contamination(docs, items, round_size=20)
    assert max(n_rows, default=0) <= D.SIZE, "the benchmark's hashes went to the driver"
    monkeypatch.undo()
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == want
    clean = {r.doc_id for r in got.where("NOT contaminated").collect()}
    assert {r.doc_id for r in D.drop_contaminated(docs, items, round_size=20).collect()} == clean
