"""chunk_invariants counts a text's visible characters once, not once per chunk."""

from queries.extraction import chunk_invariants

SF = "/root/testdata/sf0.001"


def test_whole_text_is_blanked_once_per_text(spark):
    plan = chunk_invariants(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace(whole" not in plan
    assert plan.count("regexp_replace(") == 2  # the whole text once, each chunk once


def test_all_invariants_hold(spark):
    rows = chunk_invariants(spark, SF).collect()
    texts = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 0").count()
    assert sum(r.within_size == r.in_text == r.complete == r.numbered == 1 for r in rows) == texts
