"""Operator 9: removal of repeated substrings by sorting sampled suffixes.

Every byte covered by a string of ``length`` bytes that also starts anywhere else goes. The plan
is that of difference-cover suffix sorting, for prefixes of bounded length: sample suffixes so
that equal strings hold equal samples at equal offsets, name the samples, recurse on longer
names where names repeat, and decide the remaining suffixes by the samples they lead to.
The sample is not a fixed difference cover, whose two thirds of all suffixes would have to be
shuffled (see the README), but a locally consistent one:

1. Sample. A window of ``length`` bytes has ``length - core + 1`` cores of ``core`` bytes; the start of
   the leftmost core of the least hash is sampled. It depends on the window's bytes alone, so
   equal windows sample at the same offset. About one suffix in fifty is sampled.
2. Names. A sample's first name is its core's hash. Names that occur once are dropped:
   no window with such a sample occurs twice.
3. Longer names. The second name is the hash of all bytes that windows of this sample can
   cover, ``length - core`` to the left and ``length`` to the right. If that occurs twice, all
   these windows do, and the sample is done; one sample stands for the others from here on.
4. Remaining suffixes. What is left under a first name meets in one task with its bytes. For
   each offset, the suffixes that lead to a sample at this offset are sorted by the name of their
   first ``length`` bytes, and neighbours are compared. A name with more than ``task_rows``
   samples left is dealt by (offset, name) instead and counted, so no task holds a long list.
5. Each document removes the union of its covered intervals.

Names are two 64-bit hashes over different bytes or with different bases. Texts are taken as
UTF-8; nulls count as empty. Rows that repeat an id and a text are strings of their own, so
they remove each other's bytes; null ids are an id of their own. Texts below ``length`` bytes
lose nothing. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.tables import Scratch, column

_NO_ID = -(1 << 63)
#: Keys up to which a table of names is broadcast (8 to 16 bytes each); beyond, a shuffle join.
BROADCAST_ROWS = 2_000_000
#: Bytes of a text that are sampled at once; blocks overlap, so the result does not depend on it.
BLOCK = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


@cache
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse, modulo 2^64."""
    up, down = (np.cumprod(np.r_[np.uint64(1), np.full(n, b, np.uint64)]) for b in (base, pow(base, -1, 1 << 64)))
    return up, down


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _sums(data: np.ndarray, base: int, room: int) -> np.ndarray:
    """Prefix sums along the last axis from which the hash of any part follows."""
    up, _ = _powers(base, room)
    out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:data.shape[-1]], axis=-1, out=out[..., 1:])
    return out


def _runs(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least (or greatest) of each ``width`` neighbours."""
    pick, span = (np.minimum if least else np.maximum), 1
    while span * 2 <= width:
        x, span = pick(x[:-span], x[span:]), span * 2
    rest = width - span
    return pick(x[:-rest], x[rest:]) if rest else x


def sample(data: np.ndarray, length: int, core: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places, core names and whole-reach names (0 where the reach leaves the text) of the
    samples of one text (uint8), block by block. Windows of two blocks can share a sample: the
    first of them yields it."""
    width, reach, room = length - core + 1, length - core, BLOCK + 4 * length
    beyond = np.empty(0, np.int64)  # places yielded already from where the block starts
    none = np.zeros(width - 1, np.uint64)
    for at in range(0, len(data) - length + 1, BLOCK):
        # windows that start in this block; their samples lie up to ``reach`` beyond
        lo, hi = max(0, at - reach), min(len(data), at + BLOCK + 2 * length)
        sums = _sums(data[lo:hi], _BASES[0], room)
        _, down = _powers(_BASES[0], room)
        names = _mixed((sums[core:] - sums[:-core]) * down[:len(sums) - core])
        first, last = at - lo, min(at + BLOCK, len(data) - length + 1) - lo  # window starts
        lows = _runs(names[first:last + reach], width, True)
        # leftmost places at which a window's least name stands
        best = _runs(np.concatenate([none, lows, none]), width, False)
        spot = np.flatnonzero(best == names[first:first + len(best)]) + first
        if len(spot) > len(lows) // 8:  # equal names side by side: keep what is leftmost in some window
            spot = np.unique(_leftmost(names[first:last + reach], lows, width) + first)
        beyond = beyond[beyond >= at]
        spot = spot[~np.isin(spot + lo, beyond)]
        beyond = np.r_[beyond, spot[spot + lo >= at + BLOCK] + lo]
        whole = (spot + lo >= reach) & (spot + lo + length <= len(data)) & (spot >= reach) & (spot + length <= hi - lo)
        wide = np.zeros(len(spot), np.uint64)
        wide[whole] = _mixed((sums[spot[whole] + length] - sums[spot[whole] - reach]) * down[spot[whole] - reach]) | np.uint64(1)
        yield spot + lo, names[spot], wide


def _leftmost(names: np.ndarray, lows: np.ndarray, width: int) -> np.ndarray:
    """For each window, the leftmost place of its least name."""
    out = np.empty(len(lows), np.int64)
    for i in range(0, len(lows), 4096):
        part = np.lib.stride_tricks.sliding_window_view(names[i:i + 4096 + width - 1], width)[:len(lows[i:i + 4096])]
        out[i:i + 4096] = part.argmin(1) + np.arange(i, i + len(part))
    return out


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def _batch(columns: dict[str, pa.Array | np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def samples(docs: DataFrame, length: int, core: int) -> DataFrame:
    """(id, body, place, name, wide) of every sample of every document (id, body, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bodies, texts = (batch.column(c) for c in ("id", "body", "text"))
            found, size = [], 0
            for i, text in enumerate(texts):
                for part in sample(_bytes(text.as_py()), length, core):
                    found.append((ids[i].as_py(), bodies[i].as_py(), *part))
                    size += len(part[0])
                    if size > 100_000:
                        yield _joined(found)
                        found, size = [], 0
            if found:
                yield _joined(found)

    def _joined(found: list[tuple]) -> pa.RecordBatch:
        sizes = [len(f[2]) for f in found]
        place, name, wide = (np.concatenate([f[k] for f in found]) for k in (2, 3, 4))
        return _batch({"id": np.repeat(np.array([f[0] for f in found], np.int64), sizes),
                       "body": np.repeat(np.array([f[1] for f in found], np.int64), sizes),
                       "place": place.astype(np.int64), "name": name.view(np.int64), "wide": wide.view(np.int64)})

    return docs.select("id", "body", "text").mapInArrow(run, "id long, body long, place long, name long, wide long")


def _checked(table: DataFrame) -> DataFrame:
    """``table``, to be broadcast if it is small; it must be written already."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def candidates(docs: DataFrame, scratch: Scratch, length: int, core: int) -> DataFrame:
    """The samples whose name repeats, marked: ``done`` if the whole reach repeats, and ``sent``
    if their bytes are needed (not done, or the one done sample of its kind that stands
    for the others where not all are done). ``rows`` is how many of a name are sent."""
    every = samples(docs, length, core)
    shared = scratch.write(every.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name"), "names")
    found = scratch.write(every.join(_checked(shared), "name"), "candidates")
    who = F.xxhash64("id", "body", "place")
    kinds = found.groupBy("name", "wide").agg(F.count(F.lit(1)).alias("n"), F.min(who).alias("stands"))
    done = F.col("n").__gt__(1) & (F.col("wide") != 0)
    kinds = scratch.write(kinds.select("name", "wide", done.alias("done"), "stands", F.when(done, F.lit(0)).otherwise(F.col("n")).alias("open")), "kinds")
    names = scratch.write(kinds.groupBy("name").agg(F.sum("open").alias("open"), F.count(F.when(F.col("done"), 1)).alias("standing"))
                          .where("open > 0").select("name", (F.col("open") + F.col("standing")).alias("rows")).where("rows > 1"), "open")
    marked = found.join(_checked(scratch.write(kinds.where("done").select("name", "wide", "stands"), "done")), ["name", "wide"], "left")
    marked = marked.join(_checked(names), "name", "left")
    sent = F.col("rows").isNotNull() & (F.col("stands").isNull() | (F.col("stands") == who))
    marked = marked.select("id", "body", "place", "name", F.col("stands").isNotNull().alias("done"), sent.alias("sent"), "rows")
    return marked.where("done OR sent")


def _reach(docs_with_marks: DataFrame, length: int, core: int) -> DataFrame:
    """(name, rows, id, body, place, at, bytes): for each sample that is sent, the bytes that its
    windows can cover and its offset in them. Input: id, body, text, marks."""
    reach = length - core

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column("text")[i].as_py().encode()
                marks = batch.column("marks")[i].values.flatten()
                place, name, rows = (x.to_numpy() for x in marks)
                for k in range(0, len(place), 4096):
                    p = place[k:k + 4096]
                    parts = [data[max(0, x - reach):x + length] for x in p.tolist()]
                    yield _batch({"name": name[k:k + 4096], "rows": rows[k:k + 4096],
                                  "id": np.full(len(p), batch.column("id")[i].as_py(), np.int64),
                                  "body": np.full(len(p), batch.column("body")[i].as_py(), np.int64),
                                  "place": p, "at": np.minimum(p, reach), "bytes": pa.array(parts, pa.binary())})

    return docs_with_marks.select("id", "body", "text", "marks").mapInArrow(
        run, "name long, rows long, id long, body long, place long, at long, bytes binary")


def _window_names(parts: list[bytes], at: np.ndarray, length: int, core: int) -> np.ndarray:
    """Names of the windows of samples, a row each and a column per offset of the sample in
    the window; 0 where the window leaves the text."""
    reach, width = length - core, 2 * length - core
    padded = np.zeros((len(parts), width), np.uint8)
    valid = np.zeros((len(parts), reach + 1), bool)
    for i, (part, a) in enumerate(zip(parts, at.tolist(), strict=True)):
        padded[i, reach - a:reach - a + len(part)] = np.frombuffer(part, np.uint8)
        valid[i, max(0, a + length - len(part)):a + 1] = True
    sums = _sums(padded, _BASES[1], width)
    _, down = _powers(_BASES[1], width)
    offsets = np.arange(reach + 1)
    starts = reach - offsets
    names = _mixed((sums[:, starts + length] - sums[:, starts]) * down[starts]) | np.uint64(1)
    names[~valid] = 0
    return names


def _intervals(again: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) for the runs of repeated windows in each row of ``again``."""
    edge = np.diff(np.pad(again, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, low = np.nonzero(edge == 1)
    _, high = np.nonzero(edge == -1)  # offsets low .. high - 1 repeat
    return row, place[row] - (high - 1), place[row] - low + length


def _repeated(names: np.ndarray) -> np.ndarray:
    """Which names occur again in their column: sort each, compare neighbours."""
    order = np.argsort(names, axis=0)
    ordered = np.take_along_axis(names, order, 0)
    same = (ordered[1:] == ordered[:-1]) & (ordered[1:] != 0)
    hit = np.zeros(names.shape, bool)
    hit[1:] |= same
    hit[:-1] |= same
    out = np.empty_like(hit)
    np.put_along_axis(out, order, hit, 0)
    return out


def _found(ids: np.ndarray, bodies: np.ndarray, place: np.ndarray, again: np.ndarray, length: int) -> pa.RecordBatch:
    row, start, end = _intervals(again, place, length)
    return _batch({"id": ids[row], "body": bodies[row], "start": start, "end": end})


def open_intervals(sent: DataFrame, length: int, core: int, task_rows: int) -> DataFrame:
    """(id, body, start, end): what the windows of the samples that are sent cover, if they repeat."""
    def columns(batch: pa.RecordBatch) -> tuple:
        return (*(batch.column(c).to_numpy() for c in ("name", "id", "body", "place", "at")), batch.column("bytes").to_pylist())

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (name, id, body, place, row of window names) of the names still open

        def decide(parts: list[tuple]) -> pa.RecordBatch:
            name, ids, bodies, place, rows = (np.concatenate(x) for x in zip(*parts, strict=True))
            return _found(ids, bodies, place, _repeated(rows), length)

        for batch in batches:
            name, ids, bodies, place, at, parts = columns(batch)
            new = (name, ids, bodies, place, _window_names(parts, at, length, core))
            cut = int(np.searchsorted(name, name[-1])) if len(name) else 0  # the last name may go on
            if len(name) and held and cut == 0 and held[-1][0][-1] == name[-1]:
                held.append(new)
                continue
            if len(name):
                ready = [*held, tuple(x[:cut] for x in new)]
                yield decide(ready)
                held = [tuple(x[cut:] for x in new)]
        if held:
            yield decide(held)

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, ids, bodies, place, at, parts = columns(batch)
            for k in range(0, len(name), 512):
                names = _window_names(parts[k:k + 512], at[k:k + 512], length, core)
                row, offset = np.nonzero(names)
                yield _batch({"name": name[k:k + 512][row], "offset": offset, "window": names[row, offset].view(np.int64),
                              "id": ids[k:k + 512][row], "body": bodies[k:k + 512][row], "place": place[k:k + 512][row]})

    short = sent.where(F.col("rows") <= task_rows).repartition("name").sortWithinPartitions("name")
    near = short.mapInArrow(together, "id long, body long, start long, end long")
    dealt = sent.where(F.col("rows") > task_rows).mapInArrow(apart, "name long, offset long, window long, id long, body long, place long")
    again = dealt.groupBy("name", "offset", "window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    start = F.col("place") - F.col("offset")
    far = dealt.join(again, ["name", "offset", "window"]).select("id", "body", start.alias("start"), (start + length).alias("end"))
    return near.unionByName(far)


def remove_repeats(df: DataFrame, scratch: Scratch, length: int = 200, core: int = 100, id_col: str = "doc_id",
                   text_col: str = "text", task_rows: int = 32_768) -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes``, ``kept`` (binary: the remaining bytes) and
    ``spans`` (array of struct (start, end): the maximal runs removed). ``df`` is read several
    times: pass a table. ``core`` (below ``length``) sets the density of the sample."""
    docs = df.select(F.coalesce(column(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64(column(text_col)).alias("body"),
                     F.coalesce(column(text_col), F.lit("")).alias("text"))
    with scratch.part("work") as work:
        found = work.write(candidates(docs, work, length, core), "marks")
        marks = found.where("sent").groupBy("id", "body").agg(F.collect_list(F.struct("place", "name", "rows")).alias("marks"))
        sent = work.write(_reach(docs.join(marks, ["id", "body"]), length, core), "reach")
        whole = found.where("done").select("id", "body", (F.col("place") - (length - core)).alias("start"), (F.col("place") + length).alias("end"))
        covered = scratch.write(whole.unionByName(open_intervals(sent, length, core, task_rows)), "covered")
    spans = covered.groupBy("id", "body").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    joined = docs.join(spans, ["id", "body"], "left").select("id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, kept, runs = [], [], []
            for i in range(batch.num_rows):
                data = batch.column("text")[i].as_py().encode()
                pairs = batch.column("spans")[i].values
                merged: list[list[int]] = []
                if pairs is not None:
                    for s, e in zip(*(x.to_pylist() for x in pairs.flatten()), strict=True):
                        if merged and s <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([s, e])
                edges = [0, *(x for span in merged for x in span), len(data)]
                sizes.append(len(data))
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                runs.append([{"start": s, "end": e} for s, e in merged])
            yield _batch({"id": batch.column("id"), "n_bytes": np.array(sizes, np.int64), "kept": pa.array(kept, pa.binary()),
                          "spans": pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

    out = joined.mapInArrow(cut, "id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>")
    return out.select(F.when(F.col("id") != _NO_ID, F.col("id")).alias(id_col), "n_bytes", "kept", "spans")
