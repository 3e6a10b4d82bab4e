"""The quality stage doesn't depend on how frequent a text, a source or a language is in the corpus."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from pagesmith.llm.quality_rules import keep_likely

SF = "/root/testdata/sf0.01"


def kept(spark, docs):
    return {r.doc_id for r in dict(C.STAGES)["quality"](spark, docs, SF).select("doc_id").distinct().collect()}


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, kept(spark, docs)


def often(docs, labels, which, times):
    """The unlabelled rows that ``which`` names, so many times, with ids of their own; all rows once."""
    more = docs.join(labels.select("doc_id"), "doc_id", "left_anti").where(which)
    more = more.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(times))))
    return docs.unionByName(more.withColumn("doc_id", F.col("doc_id") + F.col("i") * 1_000_000).drop("i"))


@pytest.mark.parametrize("which, times", [("source = 'src0'", 20), ("lang = 'es'", 20), ("one", 500)])
def test_frequent_rows_change_nothing(spark, tables, which, times):
    docs, labels, want = tables
    if which == "one":  # the copies of a clean text
        clean = min(want - {r.doc_id for r in labels.select("doc_id").collect()})
        which = f"doc_id = {clean}"
    got = kept(spark, often(docs, labels, which, times))
    assert {k for k in got if k < 1_000_000} == want
    assert {k % 1_000_000 for k in got} == want
    assert sum(k >= 1_000_000 for k in got) == times * len({k % 1_000_000 for k in got if k >= 1_000_000}) > 0


def test_labelled_rows_count_once(spark, tables):
    docs, _, want = tables
    again = docs.where("doc_id < 20").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("i")
    assert kept(spark, docs.unionByName(again)) == want


def test_held_out_labels_are_told_apart(tables):
    docs, labels, _ = tables
    for rest in (0, 1):
        seen = labels.where(F.col("doc_id") % 2 == rest)
        held = labels.where(F.col("doc_id") % 2 != rest)
        long = docs.where(F.size(F.split("text", r"\s+")) >= 60)
        judged = held.join(long.select("doc_id"), "doc_id")
        good = judged.where("quality = 1 AND toxic = 0").select("doc_id")
        kept_ids = keep_likely(docs, seen).select("doc_id")
        assert good.count() > 100 and good.join(kept_ids, "doc_id", "left_anti").count() == 0
        assert held.where("quality = 0").join(kept_ids, "doc_id").count() == 0
