"""Operator 3: SimHash near-dedup over a byte-position inverted index with count filtering.

A fingerprint of 64 bits is eight bytes at eight positions. Two that differ in at most three
bits share at least five positional bytes. The inverted index has a posting list for what
pairs must share: of the 14 sets of four positions whose numbers xor to zero, every choice of
five positions holds at least one, so a pair sharing five bytes meets in at least one list of
(positions, their bytes), and unrelated fingerprints meet about once in 2^32. Within a list,
the shared positional bytes of each pair are tallied, pairs with fewer than five are out, and
the rest is verified by its differing bits.

Only distinct fingerprints are indexed, so copies cost nothing. A list of more than
``list_rows`` fingerprints is split: what its members do not share yet is cut into four parts,
of which a pair within three bits shares at least one, so four lists with longer keys replace
it, and so on; as the key grows the list is bounded by the bits left, at last far below the
bound. So no task sees a long list, and no cap loses a link. A task gives the links of a
list as trees of its groups, not as all pairs; groups are then joined by connected components.

Words are runs of other than white space after lower-casing A-Z, shingles are ``words_per``
words joined by a space (a shorter text: all its words), hashed by XXH64 with seed 42, and
a bit is one if over half the shingles set it. Texts without words (null, empty) have the
fingerprint 0 and link like any other. Null ids never are a group's id unless it has no
other; repeated rows share fingerprint and group; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.components import components
from marketlake.llm.tables import Scratch, column, fresh

_POSITIONS = 8
_ALL = (1 << 64) - 1


def _words(data: bytes, block: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, block by block, so that very long ones need little memory."""
    at = 0
    while at < len(data):
        to = min(len(data), at + block)
        while to < len(data) and data[to] not in b" \t\n\v\f\r":
            to += 1
        yield data[at:to].lower().split()
        at = to


def fingerprint(text: str | None, words_per: int = 3) -> int:
    """The fingerprint of one text, as an unsigned number."""
    ones, n, seen, tail = np.zeros(64, np.int64), 0, 0, []
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    for words in _words((text or "").encode()):
        seen += len(words)
        words = tail + words
        if len(words) >= words_per:
            grams = zip(*(words[i:] for i in range(words_per)), strict=False)
            hashes = np.array(list(map(digest, map(b" ".join, grams))), np.uint64)
            n += len(hashes)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        tail = words[len(words) - words_per + 1:] if len(words) >= words_per else words
    if 0 < seen < words_per:
        return digest(b" ".join(tail))
    bits = np.packbits(2 * ones > n, bitorder="little") if n else np.zeros(8, np.uint8)
    return int(bits.view(np.uint64)[0])


def with_fingerprints(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint", words_per: int = 3) -> DataFrame:
    """Replace ``text_col`` by ``out_col``, its fingerprint (long, the same 64 bits). Map-only."""
    kept = [c for c in df.columns if c not in (text_col, out_col)]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out_col, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(x.as_py(), words_per) for x in batch.column(text_col)], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(prints.view(np.int64))], names=[*kept, out_col])

    return df.select([column(c) for c in [*kept, text_col]]).mapInArrow(run, schema)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _byte_mask(positions: tuple[int, ...]) -> int:
    return sum(0xFF << 8 * p for p in positions)


#: One list key per set of four byte positions whose numbers xor to zero.
LIST_MASKS = [_byte_mask(q) for q in combinations(range(_POSITIONS), 4) if q[0] ^ q[1] ^ q[2] ^ q[3] == 0]


def _finer(mask: int, parts: int) -> list[int]:
    """``mask`` plus each of ``parts`` even parts of the bits it leaves out (in whole bytes
    while it leaves out whole ones)."""
    left = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(left) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in left[cuts[i]:cuts[i + 1]]) for i in range(parts)]


def _forest(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that hold the groups of one list together: a tree per group (indexes)."""
    out, rest = [], np.arange(len(prints))
    while len(rest) > 1:
        queue, rest = deque([rest[0]]), rest[1:]
        while queue and len(rest):
            i = queue.popleft()
            x = prints[rest] ^ prints[i]
            shared = (x.view(np.uint8).reshape(-1, _POSITIONS) == 0).sum(1)  # the tally of shared positional bytes
            near = (shared >= _POSITIONS - max_bits) & (np.bitwise_count(x) <= max_bits)
            out += [(i, j) for j in rest[near]]
            queue.extend(rest[near])
            rest = rest[~near]
    return out


def links(prints: DataFrame, scratch: Scratch, max_bits: int = 3, list_rows: int = 4096) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose groups are those of all pairs within
    ``max_bits`` (at most 3). ``prints`` has the long column ``fingerprint``, without repeats."""
    if not 0 <= max_bits <= _POSITIONS - 5:
        raise ValueError("the lists hold pairs that share five bytes: at most 3 differing bits")

    def lists(masks: list[int]):
        keys = [F.struct(F.lit(_signed(m)).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("bytes")) for m in masks]
        return F.explode(F.array(*keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 3), np.int64)  # the list that goes on in the next batch

        def pairs(rows: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)])
            found = [(rows[s + i, 2], rows[s + j, 2]) for s, e in zip(starts, [*starts[1:], len(rows)], strict=True)
                     for i, j in _forest(np.ascontiguousarray(rows[s:e, 2]).view(np.uint64), max_bits)]
            flat = np.array(found, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["a", "b"])

        for batch in batches:
            rows = np.concatenate([held, np.column_stack([batch.column(c).to_numpy() for c in ("mask", "bytes", "fingerprint")])])
            if len(rows):
                last = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(1))
                cut = last[-1] + 1 if len(last) else 0
                if cut:
                    yield pairs(rows[:cut])
                held = rows[cut:]
        if len(held):
            yield pairs(held)

    postings = prints.select(lists(LIST_MASKS).alias("k"), "fingerprint").select("k.mask", "k.bytes", "fingerprint")
    masks, short = LIST_MASKS, []
    while True:
        sizes = postings.groupBy("mask", "bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        postings = scratch.write(postings.join(sizes, ["mask", "bytes"]), "lists")
        final = 1 << max(64 - m.bit_count() for m in masks) <= max(2, list_rows)  # no list can be longer
        short.append(postings if final else postings.where(F.col("n") <= list_rows))
        longest = postings.agg(F.max("n")).first()[0] or 0
        if final or longest <= list_rows:
            break
        finer = {m: _finer(m, max_bits + 1) for m in masks}
        split = F.create_map(*(x for m, ms in finer.items() for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(k)) for k in ms)))))
        long_lists = postings.where(F.col("n") > list_rows).select("fingerprint", F.explode(split[F.col("mask")]).alias("mask"))
        postings = long_lists.distinct().select("mask", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("bytes"), "fingerprint")
        masks = sorted({k for ms in finer.values() for k in ms})
    out = None
    for part in short:
        dealt = part.select("mask", "bytes", "fingerprint").repartition("mask", "bytes").sortWithinPartitions("mask", "bytes", "fingerprint")
        found = dealt.mapInArrow(run, "a long, b long")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def groups(docs: DataFrame, scratch: Scratch, words_per: int, max_bits: int, list_rows: int) -> DataFrame:
    """``docs`` (with ``id`` and ``text`` among its columns) with ``fingerprint``, ``component_id``
    and ``component``, the least fingerprint of the group, in place of ``text``. Groups without
    an id, or with the same least one, differ in ``component`` alone."""
    prints = scratch.write(with_fingerprints(docs, "text", "fingerprint", words_per), "prints")
    distinct = scratch.write(prints.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct")
    linked = components(links(distinct.select("fingerprint"), scratch, max_bits, list_rows), scratch)
    grouped = distinct.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint")
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.select("fingerprint", "component").join(least, "component").select("fingerprint", "component_id", "component")
    every = distinct.join(named, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("component", "fingerprint").alias("component"))
    return prints.join(every, "fingerprint")


def near_dedup(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", words_per: int = 3,
               max_bits: int = 3, list_rows: int = 4096) -> DataFrame:
    """One row per input row: ``id_col``, ``fingerprint`` (long), ``component_id``, the smallest
    id reachable over links of at most ``max_bits`` differing bits, and ``component``, the least
    fingerprint of the group, which tells groups of null or repeated ids apart."""
    docs = df.select(column(id_col).cast("long").alias("id"), column(text_col).alias("text"))
    return groups(docs, scratch, words_per, max_bits, list_rows).select(F.col("id").alias(id_col), "fingerprint", "component_id", "component")


def keep_one(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", words_per: int = 3,
             max_bits: int = 3, list_rows: int = 4096) -> DataFrame:
    """``df`` with one row of each group: that of the smallest id (null ids last; among rows of the
    group that repeat the id, the one of the smallest hash over all columns, one of equal ones)."""
    ids, row = fresh(df, "id_or_last"), fresh(df, "row_hash")
    hashed = F.xxhash64(*(column(c) for c, kind in df.dtypes if not kind.startswith("map")))
    keyed = df.withColumns({ids: F.coalesce(column(id_col).cast("long"), F.lit((1 << 63) - 1)), row: hashed})
    plain = keyed.select(F.col(ids).alias("id"), F.col(row).alias("row"), column(text_col).alias("text"))
    with scratch.part("work") as work:
        found = groups(plain, work, words_per, max_bits, list_rows)
        least = found.groupBy("component").agg(F.min(F.struct("id", "row")).alias("least"))
        stays = scratch.write(least.select("least.id", "least.row"), "stays")
    kept = keyed.join(stays.toDF(ids, row), [ids, row], "left_semi")
    # equal rows all got here; one of them stays (the join's partitioning and order serve again)
    return kept.dropDuplicates([ids, row]).select(*(column(c) for c in df.columns))
