"""Operator 10: token counts by heap-and-linked-list byte-pair merging.

A word starts as a linked list of its bytes. A heap holds the ranked adjacent pairs; the pair
of the lowest rank (the leftmost of equals) is popped again and again and its two symbols
become one. The count is the initial symbols less the merges: no identifier is looked up.

Map-only: each task counts its own rows, batch by batch; a Python worker remembers the counts
of a bounded number of chunks. Nulls count as empty, empty texts have 0 tokens, equal rows
give equal counts, other columns pass through; ``n_bytes``, ``n_tokens`` and ``over_limit``
replace columns of those names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm import byte_bpe


def pair_table(vocab: byte_bpe.Vocabulary) -> dict[int, int]:
    """(left id << 32 | right id) -> (rank << 32 | id of both together)."""
    ids = vocab.ids
    return {ids[a] << 32 | ids[b]: rank << 32 | ids[a + b] for (a, b), rank in vocab.merges.items()}


def count_word(symbols: list[int], table: dict[int, int]) -> int:
    """Tokens of one word, given as the symbols of its bytes: the symbols less the merges."""
    n = len(symbols)
    if n < 2:
        return n
    look = table.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # the linked list
    heap = [found >> 32 << 32 | i for i in range(n - 1) if (found := look(symbols[i] << 32 | symbols[i + 1])) is not None]
    heapq.heapify(heap)  # rank and place in one number: the leftmost of equal ranks is first
    merges = 0
    while heap:
        least = heapq.heappop(heap)
        i = least & 0xFFFFFFFF
        j = after[i]
        if j >= n or (found := look(symbols[i] << 32 | symbols[j])) is None or found >> 32 != least >> 32:
            continue  # one of the two was merged meanwhile
        merges += 1
        symbols[i], symbols[j] = found & 0xFFFFFFFF, -1  # no pair has a negative symbol
        after[i] = k = after[j]
        after[j] = n
        if k < n:
            before[k] = i
            if (found := look(symbols[i] << 32 | symbols[k])) is not None:
                heapq.heappush(heap, found >> 32 << 32 | i)
        h = before[i]
        if h >= 0 and (found := look(symbols[h] << 32 | symbols[i])) is not None:
            heapq.heappush(heap, found >> 32 << 32 | h)
    return n - merges


class _Counter(dict):
    """chunk -> tokens, filled on demand and bounded."""

    def __init__(self, vocab: byte_bpe.Vocabulary):
        super().__init__()
        self.table = pair_table(vocab)
        self.byte = [vocab.ids[bytes([b])] for b in range(256)]

    def __missing__(self, chunk: str) -> int:
        n = sum(count_word([self.byte[b] for b in w.encode()], self.table) for w in byte_bpe.words(chunk))
        if len(chunk) <= 256:  # a long chunk hardly comes again
            if len(self) >= byte_bpe.MAX_REMEMBERED:
                self.clear()
            self[chunk] = n
        return n


@cache
def _counter(vocabulary: str) -> _Counter:
    return _Counter(byte_bpe.load_vocabulary(vocabulary))


def count_tokens(df: DataFrame, vocabulary: str, limit: int = 512, text_col: str = "text") -> DataFrame:
    """Add ``n_bytes`` (of UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``vocabulary`` is the path of a byte-level BPE ``.json`` that every executor can read."""
    own = ("n_bytes", "n_tokens", "over_limit")
    kept = [c for c in df.columns if c not in own]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = byte_bpe.load_vocabulary(vocabulary)
        known = _counter(vocabulary)
        for batch in batches:
            texts = batch.column(text_col)
            n_tokens = [0 if t is None else sum(len(p) if special else sum(map(known.__getitem__, p))
                                                for special, p in byte_bpe.pieces(t, vocab))
                        for t in (x.as_py() for x in texts)]
            n_bytes = pc.fill_null(pc.cast(pc.binary_length(texts), pa.int64()), 0)
            tokens = pa.array(n_tokens, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), n_bytes, tokens, pc.greater(tokens, limit)],
                                             names=[*kept, *own])

    return df.select([F.col(f"`{c}`") for c in kept]).mapInArrow(count, schema)
