"""README-promised quality steps the reference code lacks (J1-J3, J5); all opt-in."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _no_key(keys: Sequence[str]) -> Column:
    return reduce(or_, (F.col(k).isNull() for k in keys))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys`` group: the first by ``order``, then by a hash of the row (equal rows
    are interchangeable). Rows with a NULL key part are not duplicates of anything: all stay,
    and a salt spreads them, so a huge NULL group never lands in one task. One pass."""
    salt = F.when(_no_key(keys), F.monotonically_increasing_id() % 4096)
    w = Window.partitionBy(*keys, "_salt").orderBy(*[F.col(c).asc_nulls_last() for c in order], "_hash")
    plain = [c for c, kind in df.dtypes if not kind.startswith("map")]
    ranked = df.withColumns({"_salt": salt, "_hash": F.xxhash64(*plain)}).withColumn("_rn", F.row_number().over(w))
    return ranked.filter((F.col("_rn") == 1) | F.col("_salt").isNotNull()).drop("_rn", "_salt", "_hash")


def not_stored(df: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not among the ``stored`` ones; rows with a NULL key part stay.
    Only the key columns of ``stored`` are read."""
    return df.join(stored.select(*keys).where(~_no_key(keys)), list(keys), "left_anti")


def dedup_trades(df: DataFrame, by: Sequence[str] = ("product_id", "trade_id")) -> DataFrame:
    """J1 (batch): keep the earliest-ingested copy of each trade."""
    return keep_first(df, by, ("ingest_ts",))


def dedup_ticker(df: DataFrame, with_client: bool = False) -> DataFrame:
    """J2 (batch): keep the earliest copy of each (product, message sequence) ticker row.
    Needs ``silver_ticker(..., keep_sequence=True)``."""
    keys = ("product_id", "sequence_num") + (("client_id",) if with_client else ())
    return keep_first(df, keys, ("ingest_ts",))


# fixed values: the trade sides the feed sends
TRADE_SIDES = ("BUY", "SELL")


def trade_checks() -> list[tuple[str, Column]]:
    """J3 rules for silver trades: (reason, condition that FAILS the row)."""
    return [
        ("missing_product_id", F.col("product_id").isNull() | (F.length("product_id") == 0)),
        ("missing_trade_id", F.col("trade_id").isNull()),
        ("bad_event_ts", F.try_to_timestamp(F.col("event_ts")).isNull()),
        ("bad_price", F.col("price").isNull() | (F.col("price") <= 0)),
        ("bad_size", F.col("size").isNull() | (F.col("size") < 0)),
        ("bad_side", F.col("side").isNull() | ~F.col("side").isin(*TRADE_SIDES)),
    ]


def validate(df: DataFrame, checks: list[tuple[str, Column]] | None = None, lost: str | None = None) -> DataFrame:
    """Add ``dq_reasons`` (array of failed rule names) and ``dq_valid``; map-only. ``lost`` names an array
    column of columns whose values did not convert (J7): reasons of their own, ``type:<column>``."""
    checks = checks if checks is not None else trade_checks()
    failed = [F.when(cond, F.lit(name)) for name, cond in checks]
    reasons = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    if lost:
        reasons = F.concat(reasons, F.transform(lost, lambda c: F.concat(F.lit("type:"), c)))
    marked = df.withColumn("dq_reasons", reasons)
    return (marked.drop(lost) if lost else marked).withColumn("dq_valid", F.size("dq_reasons") == 0)


def split_valid(df: DataFrame, checks: list[tuple[str, Column]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their reasons)."""
    v = validate(df, checks)
    return v.filter("dq_valid").drop("dq_reasons", "dq_valid"), v.filter(~F.col("dq_valid"))


def target50_filter(df: DataFrame) -> DataFrame:
    """Also drop rows without the 50-ahead target."""
    return df.filter(F.col("target_return_50").isNotNull())
