"""Operator 5: exact dedup over an extendible-hash index on shared files (native).

1. Slots. Every row becomes a slot (id, 64-bit key of the normalised text, its SHA-256, the
   text itself), written once to the shared folder; all later steps read those files.
2. Directory. It starts with one bucket; a bucket of more than ``bucket_keys`` distinct keys
   splits in two by the next leading bit of the key, and the directory doubles, until none is
   overfull. Bucket sizes at every depth come from one count of distinct keys per fine prefix,
   so the doubling is a small aggregation and not a pass over the data per level. A key that
   many rows share counts once: copies never split a bucket.
3. Owners. Rows of the same bucket, key and bytes are first combined where they are read (a
   hot group ships one row per task), then meet at the owner of their bucket's key range.
   Keys equal but bytes different stay apart, chained under the key in order of their ids.
4. Each slot looks its chain entry up by key and digest; a hot key on the slots' side can be
   split by adaptive execution, as the index has one row per distinct text.

Texts are equal when identical after every run of white space is replaced by one space. Null
counts as empty; null ids sort last and are kept only if no other id has the text. Rows that
repeat an id and a text all count in ``group_size`` and give a row each. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.tables import Scratch, column

#: Stands for a null id inside the index.
_NO_ID = (1 << 63) - 1
#: Runs of white space that are not one space already.
_RUNS = r"[\t-\r][ \t-\r]*| [ \t-\r]+"


def normalised(text: Column) -> Column:
    """Each run of space, tab, line feed, vertical tab, form feed and carriage return as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def directory(slots: DataFrame, bucket_keys: int, fine_bits: int) -> DataFrame:
    """The directory: one row per non-empty fine prefix with the ``bucket`` it points to,
    named by its depth and leading bits. ``fine_bits`` is the largest depth."""
    distinct = slots.select("key").distinct()
    fine = distinct.groupBy(F.shiftrightunsigned("key", 64 - fine_bits).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    levels = fine.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(fine_bits)))).withColumn(
        "bits", F.expr(f"shiftright(prefix, {fine_bits} - depth)"))
    sizes = levels.groupBy("depth", "bits").agg(F.sum("n").alias("size"))
    # the first level at which a prefix's bucket is not overfull; the deepest holds what is left
    fits = levels.join(sizes, ["depth", "bits"]).where((F.col("size") <= bucket_keys) | (F.col("depth") == fine_bits))
    found = fits.groupBy("prefix").agg(F.min("depth").alias("depth"))
    return found.select("prefix", F.expr(f"depth * {1 << 40} + shiftright(prefix, {fine_bits} - depth)").alias("bucket"))


def index_texts(slots: DataFrame, bucket_keys: int, fine_bits: int) -> DataFrame:
    """The index: one row per distinct text with its bucket, key, place in the key's chain,
    digest, smallest id and number of rows. ``slots`` has key, digest, body and id."""
    combined = (slots.groupBy("key", "body").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("size"))
                .withColumn("prefix", F.shiftrightunsigned("key", 64 - fine_bits)))
    # texts are compared and gone; only fixed-size entries go on to the owners
    entries = combined.select("prefix", "key", F.sha2("body", 256).alias("digest"), "keep", "size")
    owned = entries.join(directory(slots, bucket_keys, fine_bits), "prefix").repartition("bucket")
    chain = Window.partitionBy("bucket", "key").orderBy("keep", "digest")
    return owned.select("bucket", "key", F.row_number().over(chain).alias("chain"), "digest", "keep", "size")


def dedup(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
          bucket_keys: int = 4096, fine_bits: int | None = None) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256`` of the normalised text. ``bucket_keys`` is a bucket's capacity,
    ``fine_bits`` the largest depth of the directory (at most 32; by default 3 more than
    evenly filled buckets need, so it grows with the number of rows)."""
    body = normalised(column(text_col))
    slots = scratch.write(
        df.select(column(id_col).cast("long").alias("id"), body.alias("body"))
        .select("id", "body", F.xxhash64("body").alias("key"), F.sha2("body", 256).alias("digest")), "slots")
    if fine_bits is None:
        fine_bits = min(32, max(1, slots.count() // bucket_keys).bit_length() + 3)
    known = slots.withColumn("id", F.coalesce("id", F.lit(_NO_ID)))
    index = scratch.write(index_texts(known, bucket_keys, fine_bits), "index")
    found = slots.select("id", "key", "digest").join(index.select("key", "digest", "keep", "size"), ["key", "digest"])
    keep = F.when(F.col("keep") != _NO_ID, F.col("keep"))
    return found.select(F.col("id").alias(id_col), keep.alias("keep_id"), F.col("size").alias("group_size"),
                        keep.eqNullSafe(F.col("id")).alias("kept"), F.col("digest").alias("text_sha256"))
