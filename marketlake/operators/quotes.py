"""Latest quote per (product, time bucket) and its left join onto trades (gold F4-F8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions import bucket_time, pct_distance

QUOTE_COLUMNS = ("best_bid", "best_ask")
SPREAD_COLUMNS = ("bid_ask_spread", "spread_pct", "price_vs_bid", "price_vs_ask")


def last_per_bucket(
    ticker: DataFrame,
    unit: str = "minute",
    ts: str = "event_ts_dt",
    keys: Sequence[str] = ("product_id",),
    values: Sequence[str] = QUOTE_COLUMNS,
    tiebreak: Sequence[str] = ("ingest_ts",),
    bucket_col: str = "minute_ts",
) -> DataFrame:
    """The last ticker row of each (key, bucket): one row per group.

    "Last" is the greatest event time; equal times fall back to ``tiebreak`` and then to the
    quote values themselves, so the pick is deterministic (the reference leaves such ties
    to chance). One aggregation with a partial (map-side) step: each task ships at most one
    row per group into the shuffle, whatever the number of ticker rows.
    """
    t = ticker.where(F.col(ts).isNotNull()).withColumn(bucket_col, bucket_time(unit, ts))
    order = F.struct(*[F.col(c) for c in (ts, *tiebreak, *values)])
    picked = t.groupBy(*keys, bucket_col).agg(
        F.max_by(F.struct(*[F.col(v) for v in values]), order).alias("_q")
    )
    return picked.select(*keys, bucket_col, *[F.col(f"_q.{v}").alias(v) for v in values])


def attach_quotes(
    trades: DataFrame,
    quotes: DataFrame,
    unit: str = "minute",
    ts: str = "event_ts_dt",
    keys: Sequence[str] = ("product_id",),
    bucket_col: str = "minute_ts",
) -> DataFrame:
    """Left-join each trade to the quote row of its (key, bucket); trade rows are kept 1:1.

    Join strategy is left to AQE: it broadcasts the quote side when its measured size is
    under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise (quote rows
    grow with products x buckets).
    """
    left = trades.withColumn(bucket_col, bucket_time(unit, ts))
    return left.join(quotes, on=[*keys, bucket_col], how="left").drop(bucket_col)


def quotes_by_chunk(
    indexed: DataFrame,
    quotes: DataFrame,
    chunk_rows: int,
    unit: str = "minute",
    keys: Sequence[str] = ("product_id",),
    values: Sequence[str] = QUOTE_COLUMNS,
    ts: str = "event_ts_dt",
    bucket_col: str = "minute_ts",
    index_col: str = "_r",
) -> DataFrame:
    """Quote rows addressed to the halo chunks that hold trades of their (key, bucket).

    The chunk map ``(key, bucket) -> chunk`` is a distinct over the numbered trades (partial
    aggregation, one row per trade-minute and chunk), so only the quote table and this map
    are shuffled for the join, never the trades. A minute whose trades straddle a chunk
    boundary sends its quote to both chunks.
    """
    chunk = F.floor(F.col(index_col) / F.lit(chunk_rows)).cast("long")
    cmap = (indexed.select(*keys, bucket_time(unit, ts).alias(bucket_col), chunk.alias("_chunk"))
            .where(F.col(bucket_col).isNotNull())
            .distinct())
    return (quotes.join(cmap, on=[*keys, bucket_col], how="inner")
            .select(*keys, bucket_col, "_chunk", *values,
                    F.lit(False).alias("_own"), F.lit(True).alias("_is_quote")))


def chunk_quote_columns(
    keys: Sequence[str] = ("product_id",),
    values: Sequence[str] = QUOTE_COLUMNS,
    bucket_col: str = "minute_ts",
) -> list[tuple[str, Column]]:
    """F7 inside the halo partitions: every row takes the values of the (single) quote row of
    its (key, chunk, bucket). The window's partition keys extend the exchange's
    (key, chunk) partitioning, so it needs a sort but no shuffle. NULL when the bucket has no
    quote, like the reference's left join."""
    wq = Window.partitionBy(*keys, "_chunk", bucket_col)
    return [(v, F.max(F.when(F.col("_is_quote"), F.col(v))).over(wq)) for v in values]


def spread_features(price: str = "price", bid: str = "best_bid", ask: str = "best_ask") -> list[tuple[str, Column]]:
    """E52-E55. ``spread_pct`` is NULL when bid > 0 and ask is missing (its guard omits ask)."""
    b, a = F.col(bid), F.col(ask)
    return [
        ("bid_ask_spread", F.when(a.isNotNull() & b.isNotNull(), a - b).otherwise(F.lit(0.0))),
        ("spread_pct", F.when(b.isNotNull() & (b > 0), ((a - b) / b) * 100).otherwise(F.lit(0.0))),
        ("price_vs_bid", pct_distance(price, bid)),
        ("price_vs_ask", pct_distance(price, ask)),
    ]
