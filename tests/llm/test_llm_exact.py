"""Operator 5 against a dictionary."""

from __future__ import annotations

import re
from collections import defaultdict

import pytest
from llm_helpers import odd_documents, scratch  # noqa: F401
from pyspark.sql import functions as F

from marketlake.llm import exact_dedup


def _plain(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize(("bucket_keys", "fine_bits"), [(4096, None), (2, 3), (1, 12)])
def test_groups(spark, scratch, bucket_keys, fine_bits):  # noqa: F811
    df = odd_documents(spark, "id body key digest keep size").unionByName(spark.createDataFrame(
        [(100, "a \t\n b"), (101, "a b"), (102, "a  b"), (103, " a b")], "doc_id long, text string"), allowMissingColumns=True)
    groups = defaultdict(list)
    for r in df.collect():
        groups[_plain(r.text)].append(r.doc_id)
    want = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        want += [(i, keep, len(ids), i == keep) for i in ids]
    got = exact_dedup.dedup(df, scratch, bucket_keys=bucket_keys, fine_bits=fine_bits).collect()
    order = lambda rows: sorted((tuple(r)[:4] for r in rows), key=str)
    assert order(got) == order(want)
    assert exact_dedup.dedup(df.limit(0), scratch).count() == 0


def test_directory_splits_overfull_buckets_only(spark):
    keys = [(i << 60) - (1 << 63) for i in range(8)] * 5 + [-1 - i for i in range(20)]
    slots = spark.createDataFrame([(k,) for k in keys], "key long")
    rows = exact_dedup.directory(slots, 4, 6).collect()
    size = defaultdict(int)
    for r in rows:
        size[r.bucket] += sum(1 for k in set(keys) if (k % (1 << 64)) >> 58 == r.prefix)
    deep = max(b >> 40 for b in size)
    assert all(n <= 4 or b >> 40 == 6 for b, n in size.items()) and deep == 6 and min(b >> 40 for b in size) < 3


def test_equal_keys_are_chained_by_bytes(spark, scratch):  # noqa: F811
    slots = spark.createDataFrame([(7, "x", 3), (7, "y", 1), (7, "x", 2)], "key long, body string, id long")
    rows = exact_dedup.index_texts(slots, 10, 2).orderBy("chain").collect()
    assert [(r.chain, r.keep, r["size"], r.digest) for r in rows] == [
        (1, 1, 1, slots.select(F.sha2(F.lit("y"), 256)).first()[0]), (2, 2, 2, slots.select(F.sha2(F.lit("x"), 256)).first()[0])]
