"""Operator 2: line dedup by a segment-partition edit join (native).

A line goes if an equal line, or one within ``max_edits`` edits, stands earlier in the corpus;
the first of its kind stays. The order is that of documents' ids, then of lines. Lines are
compared without white space at their ends and with every other run of it as one space; lines
of fewer than ``min_chars`` characters are not compared for edits, those of fewer than
``equal_from`` not at all. ``bands`` in place of the two numbers lets the edits grow with the
length: pairs of (least length, edits); the shorter line of two decides. Texts are split at
line feeds.

1. Lines. A line is known by two 64-bit hashes. One table, written once, holds every line with its hashes and
   place; copies are combined by their hashes into one row with the first place and the number of occurrences, so
   equality is settled first, and copies are combined before the shuffle. Later copies make no keys
   (where the repeated lines are too many to be broadcast they do, the same ones).
2. Segments. Lengths fall into classes (an eighth of a power of two wide, never across two bands).
   A class has one width of segments, ``max_edits + 1`` of which fit its shortest line; the first
   ones are laid from the line's start, the last ones from its end, and what lies between belongs
   to none. Of two lines within that many edits, the shorter one has a segment i that stands
   unchanged in the longer one with exactly i edits before it, so it is shifted by at most i against
   the start and by at most ``max_edits - i`` against the end. Each line writes its segments
   to the index of its class, and probes the index with the substrings at these shifts; a line
   a few characters beyond a class probes the index of that class too. This makes 2, 5 or 8
   rows of hashes for one, two or three edits.
3. Candidates. Keys that one line alone has are dropped; lines that share one are paired.
   A key that more than ``hot_rows`` distinct lines share (a common opening, say) is not
   paired. With one edit, its lines are keyed anew by everything but one of 16 parts, and those
   that still share a key with many by everything but one character. There, lines of one
   key are within an edit, and an aggregation per key takes the place of pairs. With more
   edits, its lines are cut into one segment more and keyed by every two of them (two stay
   unchanged). Lists that are long even then are compared with their earliest line first, and only
   lines without an earlier near one so far are compared with the others. All these lists give only pairs whose
   signatures (length, parities of 64 classes of characters and of pairs of them) differ no more than the edits allow.
4. Verification by banded bit-parallel edit distance, over the texts of candidates alone, after a
   cheap test that drops most pairs.
5. Each document drops the places of lines that are not their line's first, or whose line has
   an earlier near line.

Only fixed-size rows and candidates are shuffled before the last join. Very long lines and texts are
split into lines and substrings inside the row; a line must fit a row.

Null texts stay null; a text left without lines becomes empty. Rows that repeat an id and a
text count as one document and keep the same lines; null ids come last. Empty tables give
empty results; other columns pass through, whatever their names, but for one named as
``removed_col``, which is replaced. ``docs`` is read several times: pass a table.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, pairwise, product
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.tables import Scratch, column, fresh

#: Stands for a null id in the order of documents.
_LAST = (1 << 63) - 1
#: More than the lines of a text.
_PLACES = 1 << 31
#: Edits by length for a corpus: one to three, about one in forty characters; and the least length
#: of lines that are compared for equality. Blank lines stay.
BANDS, EQUAL_FROM = ((20, 1), (60, 2), (120, 3)), 1
#: Rows (8 to 24 bytes each) up to which keys are broadcast; beyond, they are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Bytes up to which candidates' texts are broadcast.
BROADCAST_BYTES = 8 << 20


def _body(text: Column) -> Column:
    return F.xxhash64(text)


def eligible_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, body, pos, at, line, n, h1, h2): the lines to compare, in their compared form.
    ``at`` is a line's place in the corpus order; the last bit of h2 is free. ``docs`` has doc and text."""
    # the body in a select of its own: beside the generator it would be hashed for every line
    split = docs.select("doc", _body(F.col("text")).alias("body"), F.split("text", "\n").alias("lines"))
    raw = split.select("doc", "body", F.posexplode_outer("lines").alias("pos", "raw"))
    odd = reduce(or_, (F.contains("raw", F.lit(x)) for x in ("  ", "\t", "\x0b", "\f", "\r")))  # the expression only where it changes a line
    even = F.when(odd, F.regexp_replace("raw", r"[ \t\x0B\f\r]+", " ")).otherwise(F.col("raw"))
    lines = raw.select("doc", "body", "pos", F.trim(even).alias("line")).withColumn("n", F.length("line")).where(F.col("n") >= min_chars)
    at = (F.col("doc").cast("decimal(38,0)") * F.lit(_PLACES).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)")).cast("decimal(38,0)")
    return lines.select("doc", "body", "pos", at.alias("at"), "line", "n", F.xxhash64("line").alias("h1"),
                        F.xxhash64(F.lit(1), F.col("line")).bitwiseAND(F.lit(-2)).alias("h2"))


# roles of a key row: of the index, a probe of it, and for one edit the line as it is
_INDEX, _PROBE, _OWN = 0, 1, 2

Bands = tuple[tuple[int, int], ...]
Spans = list[tuple[int, int, int]]


def _spans(bands: Bands) -> Spans:
    """(least length, first length beyond, edits) of each band."""
    ends = [low for low, _ in bands[1:]] + [(1 << 31) - 1]
    return [(low, end, edits) for (low, edits), end in zip(bands, ends, strict=True)]


def _class(n: Column, low: int) -> Column:
    """The least length of the class of a length of the band from ``low`` on."""
    step = F.call_function("shiftleft", F.lit(1), F.greatest(F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int") - 3, F.lit(0)))
    return F.greatest(n - n % step, F.lit(low))


def _classes(lines: DataFrame, spans: Spans) -> DataFrame:
    """A row per line and class that it belongs to or probes, as ``class``: ``least`` (which class), ``edits``, ``role``.

    Rows are multiplied first and judged by one expression then: an array of an expression for each case
    makes a generated method of more than 8,000 bytes, which the JVM does not compile."""
    def of_band(m: Column, place: int) -> Column:
        return reduce(lambda chain, s: chain.when((m >= s[0]) & (m < s[1]), F.lit(s[place])), spans[1:],
                      F.when((m >= spans[0][0]) & (m < spans[0][1]), F.lit(spans[0][place])))

    shorter = F.array(*(F.lit(less) for less in range(max(edits for *_, edits in spans) + 1)))
    each = lines.withColumn("less", F.explode(shorter)).withColumn("m", F.col("n") - F.col("less"))
    each = each.withColumns({name: of_band(F.col("m"), place) for place, name in enumerate(("low", "end", "edits"))})
    m, low, least = F.col("m"), F.col("low"), _class(F.col("m"), F.col("low"))
    beyond = (m + 1 >= F.col("end")) | (_class(m + 1, low) != least)  # the last length of a class
    each = each.where((F.col("less") == 0) & low.isNotNull() | (F.col("less") <= F.col("edits")) & beyond)
    role = F.when(F.col("less") > 0, F.lit(_PROBE)).otherwise(F.lit(_INDEX))
    return each.select(*lines.columns, F.struct(least.alias("least"), "edits", role.alias("role")).alias("class"))


def _cuts(edits: int, intact: int) -> list[tuple[tuple[int, bool, int], ...]]:
    """For every choice of ``intact`` of ``edits + intact`` segments, and every shift of each: (segment,
    whether it is laid from the start, shift). The t-th chosen one, segment i, has i - t edits before it, so
    no more edits than there are segments between two chosen ones come between their shifts."""
    def places(t: int, i: int) -> list[tuple[int, bool, int]]:
        before, after = i - t, edits - (i - t)
        return [(i, before <= after, s) for s in range(-min(before, after), min(before, after) + 1)]

    every = (cut for chosen in combinations(range(edits + intact), intact) for cut in product(*(places(t, i) for t, i in enumerate(chosen))))
    return [cut for cut in every if all(a[1] != b[1] or abs(b[2] - a[2]) < b[0] - a[0] for a, b in pairwise(cut))]


def segment_keys(lines: DataFrame, spans: Spans, intact: int = 1) -> DataFrame:
    """(seg, role, h1, h2): the index keys and the probes of each line; a probe without a shift
    in the line's own class is an index key. The last bit of seg tells keys for one edit."""
    n, line, least, edits = F.col("n"), F.col("line"), F.col("class.least"), F.col("class.edits")
    classes, chosen = _classes(lines, spans), None
    for k in sorted({e for *_, e in spans}):
        cuts = F.array(*(F.struct(F.lit(f"{k}:{[i for i, *_ in cut]}").alias("name"), F.lit(any(s for *_, s in cut)).alias("shifted"),
                                  *(F.struct(F.lit(i).alias("i"), F.lit(left).alias("left"), F.lit(s).alias("shift")).alias(f"p{t}")
                                    for t, (i, left, s) in enumerate(cut))) for cut in _cuts(k, intact)))
        chosen = F.when(edits == k, cuts) if chosen is None else chosen.when(edits == k, cuts)
    each = classes.withColumn("cut", F.explode(chosen))  # of a literal; one expression makes the keys
    segments = edits + intact
    width = F.floor(least / segments).cast("int")
    starts = {f"at{t}": F.when(p["left"], F.col("width") * p["i"]).otherwise(n - F.col("width") * (segments - p["i"])) + p["shift"]
              for t in range(intact) for p in [F.col(f"cut.p{t}")]}
    each = each.withColumn("width", width).withColumns(starts).where(reduce(and_, (F.col(at) >= 0 for at in starts)))
    seg = F.xxhash64(least, F.col("cut.name"), *(F.substring(line, F.col(at) + 1, F.col("width")) for at in starts))
    seg = F.shiftleft(seg, 1).bitwiseOR(F.when(edits == 1, F.lit(1)).otherwise(F.lit(0)))
    role = F.when(F.col("cut.shifted"), F.lit(_PROBE)).otherwise(F.col("class.role"))
    return each.select(seg.alias("seg"), role.alias("role"), *(c for c in ("h1", "h2", "at") if c in lines.columns))


def _key(role: int, *parts: Column | int) -> Column:
    return F.struct(F.xxhash64(*(F.lit(p) if isinstance(p, int) else p for p in parts)).alias("seg"), F.lit(role).alias("role"))


def _keyed(lines: DataFrame, keys: Column) -> DataFrame:
    own = [c for c in ("h1", "h2", "at") if c in lines.columns]
    return lines.select(*own, F.explode(keys).alias("k")).select("k.seg", "k.role", *own).where("seg IS NOT NULL")


def part_keys(lines: DataFrame, parts: int) -> DataFrame:
    """Keys for one edit: the line but for one of ``parts`` parts. A line probes the index of
    the length below by the same beginning and end."""
    def key(role: int, less: int, j: Column) -> Column:
        length = F.col("n") - less
        start, rest = F.floor(length * j / parts).cast("int"), length - F.floor(length * (j + 1) / parts).cast("int")
        line = F.col("line")
        return _key(role, length, j, F.substring(line, F.lit(1), start), F.substring(line, F.col("n") - rest + 1, rest))
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    return _keyed(lines, F.concat(F.transform(every, lambda j: key(_INDEX, 0, j)), F.transform(every, lambda j: key(_PROBE, 1, j))))


def char_keys(lines: DataFrame) -> DataFrame:
    """Keys that only lines within one edit share: a line without its character j, for lines
    of its length (index); and for an edit that adds one, the line as it is (own) against a
    longer one without a character (probe)."""
    line, n = F.col("line"), F.col("n")
    without = lambda j: F.concat(F.substring(line, F.lit(1), j), F.substring(line, j + 2, n))
    every = F.sequence(F.lit(0), n - 1)
    return _keyed(lines, F.concat(F.transform(every, lambda j: _key(_INDEX, n, j, without(j))), F.array(_key(_OWN, n, line)),
                                  F.transform(every, lambda j: _key(_PROBE, n - 1, without(j)))))


def within(a: Column, b: Column, max_edits: int) -> Column:
    """Whether two lines are within ``max_edits`` edits, by a banded bit-parallel automaton.

    Bit k of the word for e errors is the cell of row j + k - max_edits in column j: set if that
    much of ``a`` is within e edits of the first j characters of ``b``. One character of
    ``b`` moves all words along: the diagonal stays where characters are equal or at one more
    error, an added character comes from the next diagonal, a left-out one goes to it."""
    width = 2 * max_edits + 1
    full = (1 << width) - 1
    start = F.struct(*(F.lit(sum(1 << k for k in range(max_edits, max_edits + e + 1))).alias(f"r{e}") for e in range(max_edits + 1)))

    def judged(pair: Column) -> Column:
        def step(state: Column, j: Column) -> Column:
            c, equal, words = F.get(pair["b"], j), F.lit(0), []
            for k in range(width):
                same = F.coalesce(F.get(pair["a"], j + F.lit(k - max_edits)) == c, F.lit(False))
                equal = equal.bitwiseOR(F.when(same, F.lit(1 << k)).otherwise(F.lit(0)))
            for e in range(max_edits + 1):
                word = state[f"r{e}"].bitwiseAND(equal)
                if e:
                    old = state[f"r{e - 1}"]
                    word = word.bitwiseOR(old).bitwiseOR(F.shiftright(old, 1)).bitwiseOR(F.shiftleft(words[-1], 1)).bitwiseAND(F.lit(full))
                words.append(word)
            return F.struct(*(w.alias(f"r{e}") for e, w in enumerate(words)))

        steps = F.when(pair["m"] > 0, F.sequence(F.lit(0), pair["m"] - 1)).otherwise(F.array().cast("array<int>"))
        end = pair["n"] - pair["m"] + max_edits
        last = F.aggregate(steps, start, step)[f"r{max_edits}"]
        return (end >= 0) & (end < width) & (F.call_function("shiftright", last, F.greatest(end, F.lit(0))).bitwiseAND(F.lit(1)) == 1)

    # as the variable of a lambda, the arrays of characters are made once per pair
    pair = F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b"), F.length(a).alias("n"), F.length(b).alias("m"))
    return F.transform(F.array(pair), judged)[0]


def near(a: Column, b: Column, max_edits: int) -> Column:
    """Whether two lines are within ``max_edits`` edits. Spark's bounded distance sends away, as generated
    code, the pairs that are not; the automaton, which walks texts as arrays, verifies the rest."""
    return (F.levenshtein(a, b, max_edits) >= 0) & within(a, b, max_edits)


def _checked(table: DataFrame) -> DataFrame:
    """``table``, to be broadcast if it is small; it must be written already."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _shared(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """The distinct rows of ``keys`` (a written table) whose key several lines share, with the number of rows as ``rows``."""
    sizes = keys.groupBy("seg").agg(F.min("h1").alias("x"), F.max("h1").alias("y"), F.max(F.col("role") != _PROBE).alias("indexed"))
    several = scratch.write(sizes.where("x != y AND indexed").select("seg"), "several")
    shared = scratch.write(keys.join(_checked(several), "seg").distinct(), "shared")
    return shared.join(shared.groupBy("seg").agg(F.count(F.lit(1)).alias("rows")), "seg")


def signature(line: Column) -> Column:
    """What lines within k edits have almost alike: the length ``n``, and of 64 classes each of characters and of pairs of
    neighbours whether their number is odd. An edit takes up to one character and two pairs away and adds as many."""
    def odd(places: Column, *parts: Column) -> Column:
        def bit(i: Column) -> Column:
            return F.call_function("shiftleft", F.lit(1).cast("long"), F.xxhash64(*(F.get(p, i) for p in parts)).bitwiseAND(F.lit(63)).cast("int"))
        return F.aggregate(places, F.lit(0).cast("long"), lambda bits, i: bits.bitwiseXOR(bit(i)))

    def of_chars(chars: Column) -> Column:
        n, none = F.size(chars), F.array().cast("array<int>")
        nexts = F.slice(chars, 2, n)
        return F.struct(F.length(line).alias("n"), odd(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none), chars).alias("chars"),
                        F.transform(F.array(nexts), lambda b: odd(F.when(n > 1, F.sequence(F.lit(0), n - 2)).otherwise(none), chars, b))[0].alias("pairs"))

    # as the variable of a lambda, the array of characters is made once per line
    return F.transform(F.array(F.split(line, "")), of_chars)[0]


def _maybe_near(a: Column, b: Column, edits: int) -> Column:
    """Whether signatures allow that their lines are within so many edits."""
    return ((F.abs(a["n"] - b["n"]) <= edits) & (F.bit_count(a["chars"].bitwiseXOR(b["chars"])) <= 2 * edits)
            & (F.bit_count(a["pairs"].bitwiseXOR(b["pairs"])) <= 4 * edits))


def _pairs(shared: DataFrame, max_edits: int) -> DataFrame:
    """Candidates (h1, h2, g1, g2), each once: index rows against all others of their key, but for
    those of two lines marked ``done`` and those whose signatures ``sig`` are too far apart for ``max_edits``, where
    there are such columns."""
    marks = [c for c in ("done", "sig") if c in shared.columns]
    a = shared.where(F.col("role") != _PROBE).select("seg", "h1", "h2", *marks)
    b = shared.select("seg", F.col("role").alias("role2"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), *(F.col(c).alias(f"{c}2") for c in marks))
    x, y = F.struct("h1", "h2"), F.struct(F.col("g1").alias("h1"), F.col("g2").alias("h2"))
    met = a.join(b, "seg").where((x < y) | (F.col("role2") == _PROBE) & (x != y))
    if "done" in marks:
        met = met.where(~(F.col("done") & F.col("done2")))
    if "sig" in marks:
        met = met.where(_maybe_near(F.col("sig"), F.col("sig2"), max_edits))
    low, high = F.least(x, y), F.greatest(x, y)
    return met.select(low.alias("low"), high.alias("high")).distinct().select(
        "low.h1", "low.h2", F.col("high.h1").alias("g1"), F.col("high.h2").alias("g2"))


def _verified(pairs: DataFrame, texts: DataFrame, spans: Spans) -> DataFrame:
    """(h1, h2) of the later line of each pair within the edits of its shorter line. ``texts`` has h1, h2, at, line and sig."""
    a = texts.select("h1", "h2", F.col("at").alias("a_at"), F.col("line").alias("a"), F.col("sig").alias("a_sig"))
    b = texts.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("at").alias("b_at"), F.col("line").alias("b"), F.col("sig").alias("b_sig"))
    if (texts.agg(F.sum(F.octet_length("line") + 64)).first()[0] or 0) <= BROADCAST_BYTES:
        a, b = F.broadcast(a), F.broadcast(b)  # else every pair would carry a text through a shuffle
    both = pairs.join(a, ["h1", "h2"]).join(b, ["g1", "g2"]).where(_maybe_near(F.col("a_sig"), F.col("b_sig"), max(edits for *_, edits in spans)))
    shorter, alike = F.least(F.length("a"), F.length("b")), F.lit(False)
    for low, end, edits in reversed(spans):
        alike = F.when((shorter >= low) & (shorter < end), near(F.col("a"), F.col("b"), edits)).otherwise(alike)
    x = F.struct(F.col("a_at").alias("at"), "h1", "h2")
    y = F.struct(F.col("b_at").alias("at"), F.col("g1").alias("h1"), F.col("g2").alias("h2"))
    return both.where(alike).select(F.greatest(x, y).alias("later")).select("later.h1", "later.h2")


def _hot_near(hot: DataFrame, scratch: Scratch, hot_rows: int, parts: int = 16) -> DataFrame:
    """(h1, h2) of the lines among ``hot`` (h1, h2, at, line, n, sig) with an earlier one within an edit."""
    shared = _shared(scratch.write(part_keys(hot.drop("at", "sig"), parts), "parts"), scratch)
    shared = scratch.write(shared.join(_checked(hot.select("h1", "h2", "sig")), ["h1", "h2"]), "part-lists")
    near = _verified(_pairs(shared.where(F.col("rows") <= hot_rows), 1), hot, [(0, (1 << 31) - 1, 1)])
    hottest = shared.where(F.col("rows") > hot_rows).select("h1", "h2").distinct()
    keys = char_keys(hot.join(hottest, ["h1", "h2"], "left_semi"))
    at = lambda role: F.min(F.when(F.col("role") == role, F.col("at")))
    firsts = keys.groupBy("seg").agg(at(_INDEX).alias("index_at"), at(_OWN).alias("own_at"), at(_PROBE).alias("probe_at"))
    firsts = firsts.where("index_at IS NOT NULL OR own_at IS NOT NULL AND probe_at IS NOT NULL")
    earlier = F.when(F.col("role") == _INDEX, F.col("index_at")).when(F.col("role") == _OWN, F.col("probe_at")).otherwise(F.col("own_at"))
    return near.unionByName(keys.join(firsts, "seg").where(earlier < F.col("at")).select("h1", "h2")).distinct()


def _hot_near_more(hot: DataFrame, scratch: Scratch, spans: Spans, hot_rows: int) -> DataFrame:
    """(h1, h2) of the lines among ``hot`` (h1, h2, at, line, n, sig) with an earlier one within the edits of
    its span, all of two edits and more."""
    most, sigs = max(edits for *_, edits in spans), hot.select("h1", "h2", "sig")
    shared = _shared(scratch.write(segment_keys(hot.drop("at", "sig"), spans, 2), "keys-2"), scratch)
    shared = scratch.write(shared.join(_checked(sigs), ["h1", "h2"]), "lists-2")
    found = scratch.write(_verified(_pairs(shared.where(F.col("rows") <= hot_rows), most), hot, spans).distinct(), "near-2")
    rows = shared.where(F.col("rows") > hot_rows).select("seg", "role", "h1", "h2", "sig")
    if rows.isEmpty():
        return found
    firsts = rows.join(hot.select("h1", "h2", "at"), ["h1", "h2"]).groupBy("seg").agg(F.min(F.struct("at", "h1", "h2", "sig")).alias("first")).select(
        "seg", F.lit(_INDEX).alias("role"), "first.h1", "first.h2", "first.sig")
    near = scratch.write(_verified(_pairs(rows.withColumn("role", F.lit(_PROBE)).unionByName(firsts), most), hot, spans).distinct(), "near-first")
    # what has an earlier near line need not look for another, but others may still find it
    done = found.unionByName(near).distinct().withColumn("done", F.lit(True))
    rest = rows.join(done, ["h1", "h2"], "left").withColumn("done", F.col("done").isNotNull())
    return found.unionByName(near).unionByName(_verified(_pairs(rest, most), hot, spans)).distinct()


def near_lines(lines: DataFrame, firsts: DataFrame, scratch: Scratch, spans: Spans, hot_rows: int) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier one within the edits of their span.
    ``firsts`` has h1, h2 and the first place ``at`` of every line."""
    shared = scratch.write(_shared(scratch.write(segment_keys(lines.drop("at"), spans), "segments"), scratch), "lists")
    hot_list, one = F.col("rows") > hot_rows, F.col("seg").bitwiseAND(F.lit(1)) == 1
    pairs = scratch.write(_pairs(shared.where(~hot_list), 0), "pairs")
    wanted = (pairs.select("h1", "h2").unionByName(pairs.select(F.col("g1").alias("h1"), F.col("g2").alias("h2")))
              .withColumns({"hot_one": F.lit(False), "hot_more": F.lit(False)})
              .unionByName(shared.where(hot_list).select("h1", "h2", one.alias("hot_one"), (~one).alias("hot_more")))
              .groupBy("h1", "h2").agg(F.max("hot_one").alias("hot_one"), F.max("hot_more").alias("hot_more")))
    wanted = scratch.write(firsts.select("h1", "h2", "at").join(wanted, ["h1", "h2"]), "wanted")
    texts = lines.select("h1", "h2", "at", "line", "n").join(_checked(wanted), ["h1", "h2", "at"]).distinct()
    texts = scratch.write(texts.withColumn("sig", signature(F.col("line"))), "texts")
    found = scratch.write(_verified(pairs, texts, spans).distinct(), "near")
    hot = {name: texts.where(name).select("h1", "h2", "at", "line", "n", "sig") for name in ("hot_one", "hot_more")}
    if any(edits == 1 for *_, edits in spans) and not hot["hot_one"].isEmpty():
        found = found.unionByName(_hot_near(hot["hot_one"], scratch, hot_rows))
    if (more := [s for s in spans if s[2] > 1]) and not hot["hot_more"].isEmpty():
        found = found.unionByName(_hot_near_more(hot["hot_more"], scratch, more, hot_rows))
    return scratch.write(found.distinct(), "near-all")


def _without_copies(lines: DataFrame, firsts: DataFrame, scratch: Scratch) -> DataFrame:
    """``lines`` without those that stand earlier too, as far as the repeated lines can be broadcast."""
    repeated = scratch.write(firsts.where("times > 1").select("h1", "h2", F.col("at").alias("first_at")), "repeated")
    if repeated.count() > BROADCAST_ROWS:
        return lines
    return lines.join(F.broadcast(repeated), ["h1", "h2"], "left").where("first_at IS NULL OR first_at = at").drop("first_at")


def places_to_drop(docs: DataFrame, scratch: Scratch, bands: Bands, equal_from: int, hot_rows: int = 32) -> DataFrame:
    """(doc, body, gone): the places of the lines to drop, for documents that drop some."""
    lines = scratch.write(eligible_lines(docs, min(equal_from, bands[0][0])), "lines")
    narrow = lines.select("doc", "body", "pos", "at", "h1", "h2")
    firsts = scratch.write(narrow.groupBy("h1", "h2").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("times")), "firsts")
    spans = [s for s in _spans(bands) if s[2]]
    found = near_lines(_without_copies(lines, firsts, scratch), firsts, scratch, spans, hot_rows) if spans else firsts.select("h1", "h2").limit(0)
    verdicts = firsts.join(found.withColumn("near", F.lit(True)), ["h1", "h2"], "left").where("times > 1 OR near")
    verdicts = scratch.write(verdicts.select("h1", "h2", F.when(F.col("near").isNull(), F.col("at")).alias("stays")), "verdicts")
    found = narrow.join(_checked(verdicts), ["h1", "h2"])
    gone = found.where("stays IS NULL OR stays != at").select("doc", "body", "pos").distinct()
    return gone.groupBy("doc", "body").agg(F.collect_list("pos").alias("gone"))


def dedup_lines(docs: DataFrame, scratch: Scratch, max_edits: int = 1, min_chars: int = 20, id_col: str = "doc_id",
                text_col: str = "text", removed_col: str | None = "n_removed", hot_rows: int = 32,
                bands: Bands | None = None, equal_from: int | None = None) -> DataFrame:
    """``docs`` with the remaining lines as ``text_col`` and their loss as ``removed_col``. ``bands``
    stands in place of ``max_edits`` and ``min_chars``; ``equal_from`` is their least length if not given."""
    bands = bands or ((min_chars, max_edits),)
    equal_from = bands[0][0] if equal_from is None else equal_from
    doc = F.coalesce(column(id_col).cast("long"), F.lit(_LAST))
    plain = docs.select(doc.alias("doc"), column(text_col).alias("text"))
    with scratch.part("work") as work:
        gone = scratch.write(places_to_drop(plain, work, bands, equal_from, hot_rows), "gone")
    names = [fresh(docs, n) for n in ("gone_doc", "gone_body", "gone_places")]
    gone = gone.toDF(*names)
    joined = docs.join(gone, (doc == F.col(names[0])) & (_body(column(text_col)) == F.col(names[1])), "left")
    places = F.col(names[2])
    # as the variable of a lambda, the lines are split once per text and not once per line
    pair = F.struct(F.split(column(text_col), "\n").alias("lines"), places.alias("gone"))
    left = lambda p: F.array_except(F.sequence(F.lit(0), F.size(p["lines"]) - 1), p["gone"])
    kept = F.transform(F.array(pair), lambda p: F.transform(left(p), lambda i: F.get(p["lines"], i)))[0]
    text = F.when(places.isNull(), column(text_col)).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias(text_col) if c == text_col else column(c) for c in docs.columns if c != removed_col]
    removed = [F.coalesce(F.size(places), F.lit(0)).cast("long").alias(removed_col)] if removed_col else []
    return joined.select(*columns, *removed)
