"""Operator 3 against all pairs."""

from __future__ import annotations

import random
import re

import xxhash
from llm_helpers import components_of, odd_documents, scratch  # noqa: F401

from marketlake.llm import simhash


def _print(text: str | None) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choices("aB é\n\t\v\x1c ", k=rng.randint(0, 80)))
        assert simhash.fingerprint(text) == _print(text)
    text = " ".join(rng.choices(["ab", "c", "Déf", "\x0c"], k=500))
    blocks = simhash._words
    monkeypatch.setattr(simhash, "_words", lambda data: blocks(data, 7))  # many blocks: the same result
    assert simhash.fingerprint(text) == _print(text)


def test_lists_cover_every_choice_of_five_positions():
    assert len(simhash.LIST_MASKS) == 14
    for gone in simhash.combinations(range(8), 3):
        shared = simhash._ALL ^ simhash._byte_mask(gone)
        assert any(m & shared == m for m in simhash.LIST_MASKS)


def test_links_hold_all_groups_also_when_lists_are_split(spark, scratch):  # noqa: F811
    rng = random.Random(1)
    base, prints = rng.getrandbits(64), {0}
    while len(prints) < 500:
        x = base
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    want = components_of(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fingerprint long")
    for list_rows in (4096, 20):
        edges = {(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(df, scratch, 3, list_rows).collect()}
        assert all((a ^ b).bit_count() <= 3 for a, b in edges)
        assert components_of(prints, lambda a, b: (a, b) in edges or (b, a) in edges) == want  # noqa: B023


def test_documents(spark, scratch):  # noqa: F811
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r for r in simhash.near_dedup(docs, scratch).collect()}
    prints = {d.doc_id: _print(d.text) for d in docs.collect()}
    want = components_of(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert {i: (r.fingerprint % (1 << 64), r.component_id) for i, r in rows.items()} == {i: (prints[i], want[i]) for i in prints}


def test_odd_rows(spark, scratch):  # noqa: F811
    df = odd_documents(spark, "id fingerprint component_id row key")
    found = simhash.near_dedup(df, scratch).collect()
    assert len(found) == df.count()
    blank = [r for r in found if r.fingerprint == 0]
    assert {r.component_id for r in blank} == {1}  # null, empty and white space: one group, its least id
    kept = simhash.keep_one(df, scratch)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert len(rows) == len({r.component for r in found})  # component_id alone does not tell groups of null ids apart
    assert simhash.keep_one(df.limit(0), scratch).count() == simhash.near_dedup(df.limit(0), scratch).count() == 0


def test_groups_of_null_and_repeated_ids_keep_a_row_each(spark, scratch):  # noqa: F811
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(60)) for _ in range(5)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (9, texts[3]), (None, texts[4]), (8, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id or 0, r.text) for r in simhash.keep_one(df, scratch).collect()))
    assert kept == sorted([(0, texts[0]), (0, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[4])])
    assert len({r.component for r in simhash.near_dedup(df, scratch).collect()}) == 5
