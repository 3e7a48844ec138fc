"""Operator 2 against a plain loop over all earlier lines."""

from __future__ import annotations

import random
import re

import pytest
from llm_helpers import odd_documents, scratch  # noqa: F401
from pyspark.sql import functions as F

from marketlake.llm import line_dedup


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _edited(rng: random.Random, line: str) -> str:
    chars = list(line)
    for _ in range(rng.choice([0, 1, 1, 2, 3])):
        i, what = rng.randrange(len(chars) + 1), rng.choice("sid")
        chars[i:i + (what != "i")] = [] if what == "d" else [rng.choice("abé ")]
    return "".join(chars) or "a"


def _kept(docs: list[tuple], edits: int, min_chars: int) -> dict:
    seen, out = [], {}
    for doc, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = []
        for line in [] if text is None else text.split("\n"):
            plain = re.sub(r"[ \t\v\f\r]+", " ", line).strip(" ")
            if len(plain) < min_chars or not any(abs(len(plain) - len(s)) <= edits and _distance(plain, s) <= edits for s in seen):
                lines.append(line)
            if len(plain) >= min_chars:
                seen.append(plain)
        out[doc] = None if text is None else "\n".join(lines)
    return out


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_banded_distance(spark, edits):
    rng = random.Random(edits)
    pairs = [("", ""), ("", "a"), ("ab", "")]
    for _ in range(300):
        a = "".join(rng.choices("abcé", k=rng.randint(1, 25)))
        pairs.append((a, _edited(rng, a)))
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = F.col("a"), F.col("b")
    for r in df.select("a", "b", line_dedup.within(a, b, edits).alias("w"), line_dedup.near(a, b, edits).alias("n")).collect():
        assert r.w == r.n == (_distance(r.a, r.b) <= edits), r


@pytest.mark.parametrize(("edits", "hot_rows"), [(1, 32), (1, 2), (2, 32)])
def test_kept_lines(spark, scratch, monkeypatch, edits, hot_rows):  # noqa: F811
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 1_000_000 if hot_rows > 2 else 0)
    rng = random.Random(3)
    base = ["".join(rng.choices("abcd e", k=rng.randint(4, 26))) for _ in range(12)]
    docs = [(i or None, None if i == 5 else "\n".join(_edited(rng, rng.choice(base)) for _ in range(rng.randint(0, 8)))) for i in range(40)]
    opening = ["common opening of it " + "".join(rng.choices("01", k=7)) for _ in range(60)]
    docs += [(100 + i, "\n".join([*rng.sample(opening, 4), "x", "  spaced   out line here\t y"])) for i in range(25)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df, scratch, edits, 8, hot_rows=hot_rows).collect()}
    assert got == _kept(docs, edits, 8)


def test_odd_rows(spark, scratch):  # noqa: F811
    df = odd_documents(spark, "doc body pos at line h1 h2 gone gone_doc gone_body seg role")
    out = line_dedup.dedup_lines(df, scratch, min_chars=4)
    assert out.columns == [*df.columns, "n_removed"]
    rows = out.collect()
    assert len(rows) == df.count()
    lines = [r for r in rows if r.text and r.text.startswith("line one")]
    assert [(r.text, r.n_removed) for r in lines] == [("line one is here", 2)]
    # one id owns a line: all its rows keep it, other ids lose it
    assert {(r.doc_id, r.text) for r in rows if r.doc_id in (3, 13, 14) and r.n_chars != 3} >= {(3, "same text"), (13, ""), (14, "")}
    assert sum(r.text is None for r in rows) == 1
    empty = line_dedup.dedup_lines(df.limit(0), scratch)
    assert empty.count() == 0


@pytest.mark.parametrize("hot_rows", [32, 2])
def test_edits_grow_with_the_length_and_short_lines_are_equal(spark, scratch, hot_rows):  # noqa: F811
    rng = random.Random(6)
    base = ["".join(rng.choices("abcd e", k=rng.randint(1, 45))).strip(" ") or "a" for _ in range(30)]
    docs = [(i or None, None if i == 5 else "\n".join(_edited(rng, rng.choice(base)) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    docs.append((100, "\n".join(["Les.", "", "Les.", " ", "", "Lez."])))
    bands, seen, want = ((10, 1), (20, 2), (30, 3)), [], {}

    def near(a: str, b: str) -> bool:
        edits = max((e for low, e in bands if min(len(a), len(b)) >= low), default=0)
        return abs(len(a) - len(b)) <= edits and _distance(a, b) <= edits

    for doc, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = []
        for line in [] if text is None else text.split("\n"):
            plain = re.sub(r"[ \t\v\f\r]+", " ", line).strip(" ")
            if not plain or not any(near(plain, s) for s in seen):
                lines.append(line)
            if plain:
                seen.append(plain)
        want[doc] = None if text is None else "\n".join(lines)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df, scratch, hot_rows=hot_rows, bands=bands, equal_from=1).collect()}
    assert got == want and got[100] == "Les.\n\n \n\nLez."


def test_cuts_leave_one_choice_intact():
    """Whatever segments the edits hit, a choice of segments is unhit and its shifts are among the cuts."""
    rng = random.Random(8)
    for edits in (1, 2, 3):
        for intact in (1, 2, 3):
            cuts = set(line_dedup._cuts(edits, intact))
            for _ in range(300):
                # edits between and inside segments: (segment or gap before it, change of length)
                hits = [(rng.randrange(edits + intact), rng.random() < 0.5, rng.choice([-1, 0, 1])) for _ in range(rng.randint(0, edits))]
                free = [i for i in range(edits + intact) if not any(h == i and inside for h, inside, _ in hits)]
                before = {i: sum(d for h, inside, d in hits if h < i or h == i and not inside) for i in free}
                total = sum(d for *_, d in hits)
                assert any(set(i for i, *_ in cut) <= set(free) and all(s == (before[i] if left else before[i] - total) for i, left, s in cut) for cut in cuts)


def _random_lines(rng: random.Random, opening: str, count: int, rest: int) -> list[str]:
    return [opening + "".join(rng.choices("abcdefghijklmnop", k=rest - 1)) + "x" for _ in range(count)]


def test_a_long_list_of_three_edits_is_not_paired(spark, scratch, monkeypatch):  # noqa: F811
    rng = random.Random(9)
    fresh = _random_lines(rng, "a common opening that very many lines of this table share", 2940, 143)
    near = [_edited(rng, line) for line in fresh[:60]]
    lines = fresh + near
    candidates = []
    real = line_dedup._verified

    def counted(pairs, texts, spans):
        candidates.append(pairs.count())
        return real(pairs, texts, spans)

    monkeypatch.setattr(line_dedup, "_verified", counted)
    df = spark.createDataFrame([(i, "\n".join(lines[i::100])) for i in range(100)], "doc_id long, text string")
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.dedup_lines(df, scratch, bands=((20, 1), (60, 2), (120, 3))).collect()}
    place = {line: (i, j) for i in reversed(range(100)) for j, line in reversed(list(enumerate(lines[i::100])))}
    plain = lambda x: re.sub(" +", " ", x).strip()
    gone = {max(place[a], place[b]) for a, b in zip(near, fresh, strict=False) if a != b and _distance(plain(a), plain(b)) <= 3}
    for i in range(100):
        mine = lines[i::100]
        assert got[i] == [x for j, x in enumerate(mine) if (i, j) not in gone and place[x] == (i, j)]
    assert sum(candidates) < 10 * len(lines) and len(gone) > 30


def test_lines_alike_at_every_cut(spark, scratch):  # noqa: F811
    """A family that differs in a few places only: lists stay long at every level."""
    rng = random.Random(10)
    frame = "".join(rng.choices("abcdefghij klmnop", k=150))
    lines = [frame[:70] + "".join(rng.choices("01", k=8)) + frame[78:] for _ in range(120)]
    docs = [(i, "\n".join(lines[i * 6:i * 6 + 6])) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df, scratch, bands=((20, 1), (60, 2), (120, 3)), hot_rows=4).collect()}
    kept, seen = {}, []
    for doc, text in docs:
        stay = []
        for x in text.split("\n"):
            if not any(_distance(x, s) <= 3 for s in seen):
                stay.append(x)
            seen.append(x)
        kept[doc] = "\n".join(stay)
    assert got == kept


def test_copies_do_not_lengthen_lists(spark, scratch, monkeypatch):  # noqa: F811
    """Two lines that share a segment, each with many copies, are one candidate and no long list; also where copies keep their keys."""
    same = "an opening of sixty characters that the two lines have alike, "
    lines = [same + "and then the first goes on in a way of its own entirely", same + "while this other one ends with quite different words here"]
    df = spark.createDataFrame([(i, lines[i % 2]) for i in range(100)], "doc_id long, text string")
    rows = []
    real = line_dedup._pairs
    monkeypatch.setattr(line_dedup, "_pairs", lambda shared, *rest: rows.append(shared.count()) or real(shared, *rest))
    for broadcast in (1_000_000, 0):
        monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", broadcast)
        got = line_dedup.dedup_lines(df, scratch, bands=line_dedup.BANDS).where("text != ''").collect()
        assert sorted(r.doc_id for r in got) == [0, 1]
    assert len(rows) == 2 and max(rows) <= 8


def test_signatures_allow_all_near_lines_and_few_others(spark):
    rng = random.Random(11)
    base = ["".join(rng.choices("abcdefg hijklmnopäß😀", k=rng.choice([0, 1, 2, 60, 150]))) for _ in range(60)]
    rows = []
    for x in base:
        for edits in (1, 2, 3):
            y = x
            for _ in range(edits):
                at = rng.randint(0, len(y))
                y = y[:at] + rng.choice(["", "z", "zß"[:1]]) + y[at + rng.randint(0, 1):]
            rows.append((x, y, edits))
    a, b = (line_dedup.signature(F.col(c)) for c in "ab")
    df = spark.createDataFrame(rows, "a string, b string, k int").select("k", a.alias("a"), b.alias("b"))
    for k in (1, 2, 3):
        assert df.where((F.col("k") <= k) & ~line_dedup._maybe_near(F.col("a"), F.col("b"), k)).count() == 0
    others = spark.createDataFrame([(x, y) for x in base for y in base if x != y and len(x) == len(y) == 150], "a string, b string")
    assert others.where(line_dedup._maybe_near(a, b, 3)).count() <= 0.01 * others.count()
