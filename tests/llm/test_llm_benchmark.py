"""Operator 4 against a scan of all windows."""

from __future__ import annotations

import random
import re

import pytest
from llm_helpers import odd_documents, scratch  # noqa: F401

from marketlake.llm import decontamination as D


def _words(text: str | None) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _brute(text: str | None, items: list[tuple], window: int) -> tuple:
    w, hit, found, unnamed = _words(text), set(), set(), False
    for item, body in items:
        iw = _words(body)
        k = min(window, len(iw))
        grams = {tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)} if k else set()
        for s in range(len(w) - k + 1 if k else 0):
            if tuple(w[s:s + k]) in grams:
                hit |= set(range(s, s + k))
                found.add(item)
    names = sorted(str(i) for i in found if i is not None)
    return len(w), len(hit), len(found), names, bool(hit)


@pytest.mark.parametrize("block_rows", [100_000, 5])
def test_hits(spark, scratch, block_rows):  # noqa: F811
    rng = random.Random(8)
    word = lambda: rng.choice(["aa", "Bb", "cc", "É", "d1", "e", "中"])
    text = lambda n: rng.choice([" ", "-", ". "]).join(word() for _ in range(n))
    items = [(i, text(rng.randint(0, 9))) for i in range(25)] + [(3, text(6)), (None, text(5)), (50, None), (51, "")]
    docs = [(i, text(rng.randint(0, 30))) for i in range(40)]
    docs += [(100, items[5][1]), (101, "x " + (items[25][1] or "") + " y"), (102, items[26][1]), (103, None), (103, items[4][1]), (103, items[4][1])]
    df = spark.createDataFrame([(*d, "own", "own") for d in docs], "doc_id long, text string, id string, w string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.decontaminate(df, bench, scratch, window=4, block_rows=block_rows).collect()
    order = lambda rows: sorted(rows, key=str)
    assert order((r.doc_id, (r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated)) for r in got) == order((i, _brute(t, items, 4)) for i, t in docs)
    clean = D.keep_clean(df, bench, scratch, window=4, block_rows=block_rows)
    assert clean.columns == df.columns
    assert order(tuple(r)[:2] for r in clean.collect()) == order(d for d in docs if not _brute(d[1], items, 4)[4])


def test_odd_rows_and_empty_tables(spark, scratch):  # noqa: F811
    df = odd_documents(spark, "id body hit_id hit_body hit items")
    bench = spark.createDataFrame([(1, "line one is here line one is here line"), (2, "SAME text")], "item_id long, text string")
    rows = D.decontaminate(df, bench, scratch).collect()
    assert len(rows) == df.count()
    assert sorted({(r.n_words, r.n_hit) for r in rows if r.contaminated}) == [(2, 2), (12, 9)]
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in D.decontaminate(df, nothing, scratch).collect())
    assert D.keep_clean(df, nothing, scratch).count() == df.count()
    assert D.decontaminate(df.limit(0), bench, scratch).count() == D.keep_clean(df.limit(0), bench, scratch).count() == 0
