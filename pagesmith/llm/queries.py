"""The registered query of every operator in this folder, with production parameters on whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pagesmith.llm.arc_warc import archive_round_trip
from pagesmith.llm.decontaminate import contamination
from pagesmith.llm.importance import resample
from pagesmith.llm.languages import identify
from pagesmith.llm.oracles import ORACLE  # noqa: F401  (registered together with the queries)
from pagesmith.llm.packing import pack
from pagesmith.llm.quality_rules import quality_scores
from pagesmith.llm.simhash import simhash_components
from pagesmith.llm.substrings import repeat_report
from pagesmith.llm.target_sampling import target_sample
from pagesmith.llm.token_files import token_round_trip
from pagesmith.llm.trie_counts import token_counts
from pagesmith.llm.url_filters import filter_urls
from pagesmith.llm.whitening import whiten

URL_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def urls(spark, sf):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(_table(spark, sf, "pages"), rules)


def benchmark_leaks(spark, sf):
    return contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def quality(spark, sf):
    return quality_scores(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def near_duplicates(spark, sf):
    return simhash_components(_table(spark, sf, "documents"))


def repeated_passages(spark, sf):
    return repeat_report(_table(spark, sf, "documents"))


def token_files(spark, sf):
    return token_round_trip(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def packed(spark, sf):
    return pack(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def importance_sample(spark, sf):
    return resample(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def unigram_counts(spark, sf):
    return token_counts(_table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def archives(spark, sf):
    return archive_round_trip(_table(spark, sf, "pages"))


def whitened(spark, sf):
    return whiten(_table(spark, sf, "embeddings"))


def target_importance(spark, sf):
    return target_sample(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def languages(spark, sf):
    return identify(_table(spark, sf, "documents"))


QUERIES = {
    "op1_url_filters": urls,
    "op2_decontamination": benchmark_leaks,
    "op3_importance_resampling": importance_sample,
    "op4_token_files": token_files,
    "op5_quality_rules": quality,
    "op6_arc_to_warc": archives,
    "op7_token_counts": unigram_counts,
    "op8_simhash": near_duplicates,
    "op9_substring_dedup": repeated_passages,
    "op10_packing": packed,
    "op11_whitening": whitened,
    "op12_target_resampling": target_importance,
    "op13_language_id": languages,
}
