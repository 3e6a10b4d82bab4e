"""Language identification: accuracy on held-out documents, independence of what mustn't be read, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagesmith.llm.languages import BUCKETS, counts_of, family, features, hyperplane, identify, letters_of
from pagesmith.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def out(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 0


@pytest.fixture(scope="module")
def found(spark):
    return QUERIES["op13_language_id"](spark, SF).collect()


def test_accuracy_on_held_out_documents(spark, found):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(found) == len(docs) and found[0].asDict().keys() == {"doc_id", "held_out", "lang_pred", "score"}
    assert all(r.held_out == out(r.doc_id) and 0 <= r.score <= 1 for r in found)
    judged = [r for r in found if r.held_out and docs[r.doc_id].lang and any(c.isalpha() for c in docs[r.doc_id].text or "")]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in judged) / len(judged)
    print("held-out accuracy", right, "of", len(judged))
    assert len(judged) > 100 and right >= 0.97
    for lang in {docs[r.doc_id].lang for r in judged}:
        own = [r for r in judged if docs[r.doc_id].lang == lang]
        assert sum(r.lang_pred == lang for r in own) / len(own) >= 0.9


def test_held_out_labels_are_never_learned(spark, found):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    key = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    changed = docs.withColumn("lang", F.when(key == 0, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
    assert sorted(identify(changed).collect()) == sorted(found)


def test_odd_rows(spark):
    texts = {"en": "the cat and the dog of this house with that", "de": "der Hund und die Katze mit dem Haus nicht",
             "fr": "le chien et la maison avec les enfants qui", "es": "el perro y la casa con los niños que", "xx-odd": "zq qz zzq qqz zqz"}
    rows = [(i, f"{t} {t.split()[i % 5]} {i}", lang) for i, (lang, t) in enumerate((kv for _ in range(30) for kv in texts.items()))]
    odd = [(1000, None, "en"), (1001, "", "de"), (1002, "123 +++ 456", "fr"), (None, "the house and the dog", None), (1003, "ß 9", None), (1004, texts["es"] + " ... ", None),
           (1005, (texts["de"] + "\n") * 40_000, None), (1006, "😀 中文", None), (7, "der Hund", "de"), (7, "der Hund", "de"), (1008, "zzq zqz", "en")]
    docs = spark.createDataFrame([*rows, *odd], "doc_id long, text string, lang string").withColumns({c: F.lit(3) for c in ("hash", "side", "pair", "distinct")})
    found = identify(docs).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows) + len(odd) and {r.lang_pred for r in found} <= {*texts, "und"}
    assert {k for k, r in by_id.items() if r.lang_pred == "und"} == {1000, 1001, 1002}
    assert all((r.score == 0) == (r.lang_pred == "und") for r in found)
    assert by_id[None].lang_pred == "en" and by_id[None].held_out and by_id[1004].lang_pred == "es" and by_id[1005].lang_pred == "de"
    assert np.mean([by_id[k].lang_pred == lang for k, _, lang in rows if k != 7]) == 1.0
    assert identify(docs.limit(0)).collect() == []
    none = identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"} and {r.score for r in none} == {0.0}
    assert {r.lang_pred for r in identify(docs.where("lang = 'de'")).collect()} == {"de", "und"}


def test_features():
    assert letters_of("Ab9  c!").tolist() == [ord(c) for c in " ab c "] and not len(letters_of("12 ?"))
    assert counts_of(letters_of("ab")).sum() == 2 + 3 + 2 + 1
    long = "ab c" * 300_000
    letters = letters_of(long)
    assert counts_of(letters).sum() == sum((letters != 32)[: len(letters)].sum() if k == 1 else len(letters) - k + 1 for k in range(1, 5))
    assert features("..") is None and abs(np.linalg.norm(features("x")) - 1) < 1e-12
    assert family("de") == family("en-GB") != family("fr") and family("tlh") == "tlh"


def test_hyperplane_separates():
    rows = [(np.array([0, i % 3 + 1]), np.array([0.6, 0.8])) for i in range(60)]
    sides = np.array([1 if i % 3 == 0 else -1 for i in range(60)])
    weights = hyperplane(rows, sides)
    assert len(weights) == BUCKETS and all(s * (weights[a] @ v) > 0.9 for (a, v), s in zip(rows, sides))
