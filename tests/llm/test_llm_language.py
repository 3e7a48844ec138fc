"""Operator 13: subwords against brute force, held-out accuracy, calibration and odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from llm_helpers import odd_documents
from pyspark.sql import functions as F

from marketlake.llm import language as L
from marketlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def subwords_by_brute_force(text: str) -> int:
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return sum(1 for w in words for n in range(1, L.LENGTHS + 1) for i in range(len(w) + 3 - n) if f" {w} "[i:i + n] != " ")


@pytest.mark.parametrize("text", ["", " ", "12", "a", "ab cd", "..a..", "hello, wörld! 12 x", "İstanbul 中文 \U00010330x", "word " * 500])
def test_subwords(text, monkeypatch):
    whole = np.sort(np.concatenate([*L.subwords(text, 1 << 15), np.empty(0, np.intp)]))
    assert len(whole) == subwords_by_brute_force(text)
    for block in (1, 2, 3, 5, 64):
        monkeypatch.setattr(L, "_BLOCK", block)
        assert np.array_equal(whole, np.sort(np.concatenate([*L.subwords(text, 1 << 15), np.empty(0, np.intp)])))


def test_held_out_accuracy(spark):
    rows = QUERIES["op13_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 250 < len(held) < 420
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.98
    assert np.mean([r.lang_pred == r.lang for r in held if r.accepted]) >= 0.99 and np.mean([r.accepted for r in held]) >= 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_only_chosen_rows_teach(spark):
    rows = [(i, ("la le les des une " if i % 2 else "the and of that with ") * 4, "fr" if i % 2 else "en") for i in range(80)]
    docs = spark.createDataFrame([*rows, *((100 + i, "la le les des une", "xx") for i in range(80))], "doc_id long, text string, lang string")
    model = L.fit(docs, learn=F.col("doc_id") < 100)
    assert model.languages == ["en", "fr"]
    assert {r.lang_pred for r in L.identify(docs.where("doc_id >= 100"), model).collect()} == {"fr"}
    swapped = docs.withColumn("lang", F.lit("zz"))
    assert L.identify(swapped, model).collect() == L.identify(docs, model).collect()  # lang is no input of a prediction


def test_the_sample_is_bounded_and_even(spark):
    docs = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 100 == 0, "rare").otherwise("often").alias("lang"), F.lit("text").alias("text"))
    sizes = {r["lang"]: r["count"] for r in L.sample(docs, 1000, 10).groupBy("lang").count().collect()}
    assert sizes["rare"] == 200 and 400 < sizes["often"] < 600
    with pytest.raises(ValueError):
        L.sample(docs.withColumn("lang", F.col("id").cast("string")), 1000, 10)


def test_calibration():
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 3, 6000)
    logits = rng.normal(0, 1, (6000, 3))
    logits[np.arange(6000), labels] += 2
    factor, threshold = L.calibrate(5 * logits, labels, 0.95)
    p = L._softmax(factor * 5 * logits)
    right = p.argmax(1) == labels
    assert abs(p.max(1).mean() - right.mean()) < 0.03  # scores are chances of being right
    assert right[p.max(1) >= threshold].mean() >= 0.95 and threshold < 1
    assert L.calibrate(np.empty((0, 3)), np.empty(0, int), 0.9) == (1.0, 0.5)


def test_odd_rows(spark):
    docs = odd_documents(spark, "lang_pred score accepted id")
    taught = spark.createDataFrame([(i, ("la le les des une " if i % 2 else "the and of that with ") * 4, "fr" if i % 2 else "en") for i in range(60)],
                                   "doc_id long, text string, lang string")
    for model in (L.fit(taught), L.fit(taught.where("lang = 'fr'")), L.fit(taught.limit(0)), L.fit(docs)):
        rows = L.identify(docs, model).collect()
        assert len(rows) == docs.count()
        texts = [r.text for r in docs.collect()]
        assert [r.lang_pred == "und" for r in rows] == [not (t and any(map(str.isalpha, t)) and model.languages) for t in texts]
        assert all((r.score == 0 and not r.accepted) if r.lang_pred == "und" else 0 < r.score <= 1 for r in rows)
    assert L.identify(docs.limit(0), model).count() == 0
    assert L.identify(docs.withColumnRenamed("doc_id", "text2").withColumnRenamed("text", "body"), model, "text2", "body").columns[0] == "text2"
