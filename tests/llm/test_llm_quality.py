"""Operator 7: held-out accuracy and odd tables."""

from __future__ import annotations

import numpy as np
from llm_helpers import odd_documents
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    seen = F.col("doc_id") % 3 != 0
    rows = Q.classify(docs, labels.where(seen)).join(labels.where(~seen), "doc_id").select("quality", "toxic", "keep", "score").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert len(rows) > 100
    assert np.mean([r.keep for r in good]) >= 0.97 and np.mean([not r.keep for r in bad]) >= 0.8


def test_pseudo_labels_reach_the_other_view():
    """One view is labelled by what the other is sure of: better than its own few labels."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 600).astype(float)
    text = np.column_stack([2 * y - 1 + 0.2 * rng.normal(size=600)] + [rng.normal(size=600) for _ in range(3)])
    meta = np.column_stack([2 * y - 1 + 0.8 * rng.normal(size=600)] + [rng.normal(size=600) for _ in range(30)])
    known = np.where(np.arange(600) < 60, y, np.nan)
    held = np.arange(600) % 2 == 0
    right = [((Q.co_train(text, meta, known, held, rounds=r).scores(text[60:], meta[60:])[1] >= 0.5) == (y[60:] == 1)).mean() for r in (0, 4)]
    assert right[1] > right[0]


def test_blocks_do_not_matter(monkeypatch):
    text = "Some text é that is cut " * 40
    whole = Q.text_features(text)
    monkeypatch.setattr(Q, "_BLOCK", 7)
    assert np.array_equal(whole, Q.text_features(text))


def test_odd_rows(spark):
    df = odd_documents(spark, "id label d p_text score keep")
    for labels in ([], [(1, 1), (3, 1)], [(i, i % 2) for i in range(15)] + [(3, None), (None, 1), (4, 1), (4, 1)]):
        table = spark.createDataFrame([(*x, 0) for x in labels], "doc_id long, quality int, toxic int")
        rows = Q.classify(df, table).collect()
        assert len(rows) == df.count()
        for r in rows:
            assert (r.score == 0 and not r.keep) if not r.text else 0 <= r.score <= 1
    assert all(r.keep for r in Q.classify(df, table.limit(0)).collect() if r.text)
    assert Q.classify(df.limit(0), table).count() == 0


def test_held_out_toxic_documents_go(spark, tmp_path):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    seen = F.col("doc_id") % 3 != 0
    labels.where(seen).write.parquet(f"{tmp_path}/labels.parquet")
    held = labels.where(~seen)
    stays = corpus_pipeline.quality_filter(spark, docs, str(tmp_path)).select("doc_id", F.lit(True).alias("stays"))
    rows = held.join(stays, "doc_id", "left").where("quality = 1").select("toxic", "stays").collect()
    assert np.mean([not r.stays for r in rows if r.toxic == 1]) >= 0.8
    assert np.mean([bool(r.stays) for r in rows if r.toxic == 0]) >= 0.97


def test_marks_are_no_chance():
    rng = np.random.default_rng(1)
    toxic = (np.arange(600) % 8 == 0).astype(float)
    found = [np.unique(np.r_[rng.integers(10, 5000, 40), [1] if t else []]).astype(np.uint64) for t in toxic]
    assert Q.fit_marks(found, toxic).words.tolist() == [1]
    for share in (0.0, 1.0):
        assert np.allclose(Q.fit_marks(found, np.full(600, share)).scores(found), share)
    assert Q.fit_marks([], np.empty(0)).scores([]).shape == (0,)


def test_packed_features_are_the_features():
    rows = [("Some text, some text é and more", "en", "web", 3.0), ("", None, None, None), (None, "en", None, 2.0), ("ab", "de", "x", None), ("x" * 90_000, "en", "web", 1.0)]
    text, meta = Q.unpack(Q.pack(*r) for r in rows)
    assert np.array_equal(text, np.array([Q.text_features(r[0]) for r in rows])) and np.array_equal(meta, np.array([Q.meta_features(*r) for r in rows]))
    assert [x.shape for x in Q.unpack([])] == [(0, Q.TEXT_DIMS), (0, Q.META_DIMS)]


def test_a_table_teaches_what_its_rows_in_memory_teach(spark):
    """Brute force: of all distinct documents a view is sure of, those of the least keys, and none twice."""
    rows = [(f"word{i % 60} {'good' if i % 2 else 'bad'} text", "en", f"s{i % 2}", float(i % 60)) for i in range(600)]
    packed = [Q.pack(*r) for r in rows]
    w = np.random.default_rng(2)
    model = Q.Model((w.normal(size=Q.TEXT_DIMS + 1), w.normal(size=Q.META_DIMS + 1)), (np.array([4.0, 0.1]), np.array([4.0, -0.1])), None)
    text, meta = Q.unpack(packed)
    keys = [Q.xxhash.xxh64_intdigest(x) >> 1 for x in packed]
    p = 1 / (1 + np.exp(-model.logits(text, meta)))
    teach = Q.Pool(0.7, 20).over_table(spark.createDataFrame([(x,) for x in packed], "packed binary").repartition(5))
    taught = [set(), set()]
    for _ in range(2):
        lessons = teach(model, 0.4)
        for giver in (0, 1):
            now = set()
            for value, sure, most in ((0.0, 1 - p[:, giver], 12), (1.0, p[:, giver], 8)):
                want = sorted({keys[i] for i in np.flatnonzero(sure >= 0.7)} - taught[giver])[:most]
                found = [x for g, v, x in lessons if (g, v) == (giver, value)]
                places = [keys.index(k) for k in want]
                assert not want and not found or np.array_equal(found[0][0], text[places]) and np.array_equal(found[0][1], meta[places])
                now |= set(want)
            taught[giver] |= now
    assert taught[0] and taught[1]


def test_a_rare_source_teaches_from_the_whole_table(spark):
    """Far more unlabelled rows than a round takes; the metadata of the last ones is learned from their texts alone."""
    docs = [(i, "aaa bbb ccc " * 5 if i % 2 else "xxx yyy zzz " * 5, "en", f"known{(i + (i % 10 == 0)) % 2}", 60) for i in range(80)]
    docs += [(i, "mmm nnn ooo " * 5, "en", "other", 60) for i in range(80, 3000)]
    docs += [(i, "aaa bbb ccc " * 5 if i % 2 else "xxx yyy zzz " * 5, "de", f"rare{i % 2}", 60 + i % 300) for i in range(3000, 3300)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    rows = Q.classify(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), labels).where("doc_id >= 3000").collect()
    assert np.mean([(r.p_meta >= 0.5) == (r.doc_id % 2 == 1) for r in rows]) >= 0.95


def test_toxic_words_counted_in_tables_are_those_counted_in_memory(spark):
    rng = np.random.default_rng(1)
    toxic = (np.arange(400) % 8 == 0).astype(float)
    found = [np.unique(np.r_[rng.integers(10, 3000, 40), [1, 2] if t else [2] if i % 80 == 1 else []]).astype(np.int64) for i, t in enumerate(toxic)]
    told = spark.createDataFrame([(i, float(t), f.tolist()) for i, (t, f) in enumerate(zip(toxic, found, strict=True))], "id long, toxic double, words array<long>")
    words, total = Q.toxic_words(told, float(toxic.mean()))
    memory = Q.fit_marks([f.astype(np.uint64) for f in found], toxic)
    assert sorted(r.word for r in words.collect()) == sorted(memory.words.tolist()) == [1, 2]
    assert total == len(set(np.concatenate(found).tolist()))
