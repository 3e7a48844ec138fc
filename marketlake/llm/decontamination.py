"""Operator 4: benchmark decontamination by a prefix-filtered set join (native).

An item's windows are its runs of ``window`` consecutive words (a shorter item is one window).
A document that holds a window holds all its words, so the rarest of them is a sufficient
prefix of the window's words ordered by rarity: the index has each distinct window once,
under that word. The document's words probe the index. A match gives the one place at which
the window could start; it must start and end inside the document (positional and length
bounds), its second-rarest word must stand where it belongs, and then the words of the
place are compared exactly.

Rarity is counted over all documents, for the benchmark's words only. Word list and index
are broadcast in blocks of at most ``block_rows`` rows, a block per pass, so a large benchmark
needs more passes but never more memory; documents are not shuffled for the search. Hits
(document, place, window) are few and are dealt by document.

Words are runs of digits, letters and all characters beyond ASCII after lower-casing A-Z. Null
and empty texts have no words; null item ids count as an item but do not appear among the
ids; rows that repeat an id and a text are judged alike; rows that repeat an item are one
item; empty documents or an empty benchmark give no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.tables import Scratch, column, fresh

_NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; plain ``lower`` where the text is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _words(text: Column) -> Column:
    """The words of a text, not yet in lower case (splitting does not depend on it)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _NO_WORD), "")


def windows(items: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """(item, words) for each window of each item; words are joined by spaces."""
    words = items.select(column(item_col).alias("item"), _words(_lower(column(text_col))).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(window - 1), F.lit(1)))
    return (words.select("item", "w", F.explode(starts).alias("s"))
            .select("item", F.array_join(F.slice("w", F.col("s"), F.lit(window)), " ").alias("words")).distinct())


def _blocks(table: DataFrame, key: str, block_rows: int) -> list[DataFrame]:
    """``table`` in parts of about ``block_rows`` rows, by a hash of ``key``, to be broadcast."""
    n = max(1, -(-table.count() // block_rows))
    return [F.broadcast(table if n == 1 else table.where(F.pmod(F.xxhash64(key), F.lit(n)) == i)) for i in range(n)]


def rarity(docs: DataFrame, vocabulary: DataFrame, block_rows: int, text_col: str) -> DataFrame:
    """(token, n): how often each word of the benchmark stands in the documents."""
    every = docs.select(F.explode_outer(_words(column(text_col))).alias("raw")).select(_lower(F.col("raw")).alias("token"))
    parts = [every.join(block, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
             for block in _blocks(vocabulary, "token", block_rows)]
    return reduce(DataFrame.unionByName, parts)


def index_windows(wins: DataFrame, counts: DataFrame) -> DataFrame:
    """The index: each distinct window under its rarest word, with the places of its two
    rarest words. Windows with a word that no document has cannot occur and are left out."""
    tokens = (wins.select("words").distinct()
              .select("words", F.posexplode(F.split("words", " ")).alias("at", "token"))
              .join(counts, "token", "left"))
    ordered = F.sort_array(F.collect_list(F.struct("n", "token", "at")))
    found = tokens.groupBy("words").agg(ordered.alias("t"), F.count("n").alias("known"), F.count(F.lit(1)).alias("k")).where("known = k")
    second = F.when(F.col("k") > 1, F.col("t")[1]).otherwise(F.col("t")[0])
    return found.select(F.col("t")[0]["token"].alias("token"), F.col("t")[0]["at"].alias("at"), F.col("k").cast("int").alias("k"),
                        second["token"].alias("token2"), second["at"].alias("at2"), "words")


def occurrences(docs: DataFrame, index: DataFrame, block_rows: int, text_col: str, keys: list[str]) -> DataFrame:
    """(``keys``, s, k, words): every place of every window in the documents."""
    placed = docs.select(*keys, _words(column(text_col)).alias("w")).select(*keys, "w", F.posexplode_outer("w").alias("p", "raw"))
    probes = placed.select(*keys, "w", "p", _lower(F.col("raw")).alias("token"))
    first = F.col("p") - F.col("at")
    parts = []
    for block in _blocks(index, "token", block_rows):
        found = probes.join(block, "token").where(
            (first >= 0) & (first + F.col("k") <= F.size("w"))
            & (_lower(F.get("w", first + F.col("at2"))) == F.col("token2"))
            & (_lower(F.array_join(F.slice("w", F.greatest(first, F.lit(0)) + 1, F.col("k")), " ")) == F.col("words")))
        parts.append(found.select(*keys, first.alias("s"), "k", "words"))
    return reduce(DataFrame.unionByName, parts)


def find(docs: DataFrame, items: DataFrame, scratch: Scratch, window: int = 10, id_col: str = "doc_id",
         text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_rows: int = 100_000) -> DataFrame:
    """The documents with hits, as (``id``, ``body``, ``n_hit``, ``items``): the id, the hash of
    the text, the words inside any occurrence of a window, and the items with occurring
    windows. ``docs`` is read twice, so it should be a table."""
    keyed = docs.select(column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("body"), column(text_col).alias("text"))
    wins = scratch.write(windows(items, window, item_col, item_text_col), "windows")
    vocabulary = scratch.write(wins.select(F.explode(F.split("words", " ")).alias("token")).distinct(), "vocabulary")
    index = scratch.write(index_windows(wins, rarity(keyed, vocabulary, block_rows, "text")), "index")
    hits = scratch.write(occurrences(keyed, index, block_rows, "text", ["id", "body"]), "hits")
    by_place = Window.partitionBy("id", "body").orderBy("s", "k").rowsBetween(Window.unboundedPreceding, -1)
    to = F.col("s") + F.col("k")
    covered = (hits.select("id", "body", "s", "k").distinct()
               .withColumn("before", F.coalesce(F.max(to).over(by_place), F.lit(0)))
               .groupBy("id", "body").agg(F.sum(F.greatest(to - F.greatest("s", "before"), F.lit(0))).cast("long").alias("n_hit")))
    named = (hits.select("id", "body", "words").distinct().join(wins, "words").groupBy("id", "body")
             .agg(F.collect_set("item").alias("items"), F.max(F.col("item").isNull().cast("int")).alias("unnamed")))
    same = F.col("c.id").eqNullSafe(F.col("n.id")) & (F.col("c.body") == F.col("n.body"))
    return covered.alias("c").join(named.alias("n"), same).select("c.id", "c.body", "n_hit", "items", "unnamed")


def decontaminate(docs: DataFrame, items: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``id_col``, ``n_words``, ``n_hit``, ``n_items``, ``items`` (array,
    sorted as strings) and ``contaminated``."""
    with scratch.part("work") as work:
        hits = scratch.write(find(docs, items, work, id_col=id_col, text_col=text_col, **options), "found")
    every = docs.select(column(id_col).alias("doc"), F.xxhash64(column(text_col)).alias("hash"),
                        F.size(_words(column(text_col))).cast("long").alias("n_words"))
    joined = every.join(hits, F.col("doc").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("body")), "left")
    names = F.array_sort(F.col("items").cast("array<string>"))
    return joined.select(F.col("doc").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                         F.coalesce(F.size(names) + F.col("unnamed"), F.lit(0)).cast("long").alias("n_items"),
                         F.coalesce(names, F.array().cast("array<string>")).alias("items"),
                         F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated ones; all columns as they were."""
    names = [fresh(docs, n) for n in ("hit_id", "hit_body")]
    with scratch.part("work") as work:
        found = find(docs, items, work, id_col=id_col, text_col=text_col, **options).select("id", "body").toDF(*names)
        hits = scratch.write(found, "found")
    same = column(id_col).eqNullSafe(column(names[0])) & (F.xxhash64(column(text_col)) == column(names[1]))
    return docs.join(hits, same, "left_anti")
