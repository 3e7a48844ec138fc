"""Operator 9 against a count of all strings."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from llm_helpers import odd_documents, scratch  # noqa: F401

from marketlake.llm import substring_dedup


def _brute(texts: list[str | None], length: int) -> list[tuple[bytes, list[tuple[int, int]]]]:
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d) + 1)
        for i in range(len(d) - length + 1):
            if counts[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        edges = [i for i in range(len(d) + 1) if gone[i] != (gone[i - 1] if i else 0)]
        out.append((bytes(b for b, g in zip(d, gone, strict=False) if not g), list(zip(edges[::2], edges[1::2], strict=True))))
    return out


@pytest.mark.parametrize(("task_rows", "block"), [(32_768, 1 << 20), (3, 1 << 20), (32_768, 64)])
def test_removed_bytes(spark, scratch, monkeypatch, task_rows, block):  # noqa: F811
    monkeypatch.setattr(substring_dedup, "BLOCK", block)
    if task_rows == 3:
        monkeypatch.setattr(substring_dedup, "BROADCAST_ROWS", 0)
    rng = random.Random(5)
    word = lambda low, high: "".join(rng.choices("abcdé ", k=rng.randint(low, high)))
    passages, texts = [word(15, 60) for _ in range(6)], []
    for _ in range(60):
        parts = [rng.choice([rng.choice(passages), word(0, 30), rng.choice(passages)[rng.randint(0, 9):], "ab" * rng.randint(0, 30),
                             "a" * rng.randint(0, 40)]) for _ in range(rng.randint(0, 5))]
        texts.append("".join(parts))
    texts += [texts[3], texts[4], None, ""]
    if block == 64:  # blocks are a matter of one text, so no workers are needed (they would not see the patch)
        for t in texts:
            data = substring_dedup._bytes(t)
            found = [p for part in substring_dedup.sample(data, 20, 10) for p in part[0].tolist()]
            monkeypatch.setattr(substring_dedup, "BLOCK", 1 << 20)
            whole = [p for part in substring_dedup.sample(data, 20, 10) for p in part[0].tolist()]
            monkeypatch.setattr(substring_dedup, "BLOCK", block)
            assert set(whole) <= set(found)
        return
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in substring_dedup.remove_repeats(df, scratch, 20, 10, task_rows=task_rows).collect()}
    for i, (kept, spans) in enumerate(_brute(texts, 20)):
        assert (bytes(rows[i].kept), [tuple(s) for s in rows[i].spans]) == (kept, spans), texts[i]


def test_odd_rows(spark, scratch):  # noqa: F811
    df = odd_documents(spark, "id body place name wide marks spans kept")
    rows = substring_dedup.remove_repeats(df, scratch).collect()
    want = Counter((len((r.text or "").encode()), k) for r, (k, _) in zip(df.collect(), _brute([r.text for r in df.collect()], 200), strict=True))
    assert Counter((r.n_bytes, bytes(r.kept)) for r in rows) == want
    assert substring_dedup.remove_repeats(df.limit(0), scratch).count() == 0


def test_blocks_share_no_sample(spark, scratch):  # noqa: F811
    rng = random.Random(9)
    text = "".join(rng.choices("abcdefghij ", k=substring_dedup.BLOCK * 2 + 5_000))
    places = [p for part in substring_dedup.sample(substring_dedup._bytes(text), 200, 100) for p in part[0].tolist()]
    assert len(places) == len(set(places))
    twice = text[:300] + "|" + text  # only the opening occurs twice
    df = spark.createDataFrame([(1, text[50_000:]), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in substring_dedup.remove_repeats(df, scratch).collect()}
    assert bytes(rows[1].kept).decode() == text[50_000:] and rows[1].spans == []
    row = substring_dedup.remove_repeats(spark.createDataFrame([(1, twice)], df.schema), scratch).first()
    assert [tuple(s) for s in row.spans] == [(0, 300), (301, 601)]
