"""Gold layer: the per-trade feature table.

Plan, for ``strategy="halo"`` (default):

1. parse event times; range-shuffle trades by (product, time, trade id) and number each
   product's rows (``row_index``; the numbered rows are written once to the shared
   checkpoint folder);
2. cut every product's sequence into chunks of ``chunk_rows`` rows with 499-row lookback and
   50-row lookahead halos; over one sort of each (product, chunk) the frames of 10 rows, lags AND
   leads are computed and the longer frames put together from them -- the leads are taken before the quote join, which keeps rows 1:1,
   so no second window shuffle is needed after it;
3. pick the last quote per (product, minute) in one partially-aggregated group-by; attach it
   by a broadcast left join when its estimated size is under the broadcast threshold, else
   inside the halo exchange (quote rows travel to the trades' chunks; no trades shuffle);
4. spread features, final filter.

``strategy="plain"`` runs the reference's single window per product (one task per product)
and a left join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions import bucket_time, utc_time
from marketlake.operators import quotes as Q
from marketlake.operators import windows as W
from marketlake.session import broadcast_threshold, estimated_bytes, partitions_for, small_methods

# Trades columns used for a total order inside a (product, time, trade id) tie.
TIEBREAK = ("ingest_ts", "price", "size", "side", "trade_time", "event_ts")
DEFAULT_CHUNK_ROWS = None  # auto: see windows.auto_chunk_rows


def parse_times(df: DataFrame, src: str = "event_ts", dst: str = "event_ts_dt") -> DataFrame:
    """ISO text -> timestamp column (UTC wall clock); bad text -> NULL."""
    return df.withColumn(dst, utc_time(src))


def trade_features(
    trades: DataFrame,
    strategy: str = "halo",
    chunk_rows: int | None = DEFAULT_CHUNK_ROWS,
    num_partitions: int | None = None,
    with_leads: bool = True,
    keys: Sequence[str] = ("product_id",),
    order: Sequence[str] = W.ORDER_COLUMNS,
    index_col: str | None = None,
    quotes: DataFrame | None = None,
    unit: str = "minute",
) -> DataFrame:
    """Windowed + derived per-trade columns (E1-E51, and E56-E61 when ``with_leads``).

    ``trades`` must already carry ``event_ts_dt``. With ``index_col`` the 0-based position
    of each trade within its product is kept under that name. With ``quotes`` (halo only:
    output of ``last_per_bucket``) the quote columns are attached inside the same exchange
    (see :func:`marketlake.operators.quotes.quotes_by_chunk`).
    """
    if quotes is not None and strategy != "halo":
        raise ValueError("quotes can be attached in the window stage only with strategy='halo'")
    small_methods(trades.sparkSession)
    if strategy == "plain":
        w = W.trade_window(keys, order)
        cols = W.window_columns(w, with_leads)
        if index_col:
            cols.append((index_col, F.row_number().over(w) - 1))
        out = W.with_columns(trades, cols)
    elif strategy == "halo":
        n = num_partitions or partitions_for(trades)
        ties = [c for c in TIEBREAK if c in trades.columns and c not in order]
        stats: dict = {}
        idx = W.row_index(trades, keys, [*order, *ties], n, stats=stats)
        if not chunk_rows:
            chunk_rows = W.auto_chunk_rows(stats.get("rows", 0), n)
        lookahead = W.LOOKAHEAD if with_leads else 0
        h = W.halo_chunks(idx, chunk_rows, W.LOOKBACK, lookahead)
        part = list(keys)
        if quotes is not None:
            h = h.withColumn("minute_ts", bucket_time(unit, "event_ts_dt")).withColumn("_is_quote", F.lit(False))
            h = h.unionByName(Q.quotes_by_chunk(idx, quotes, chunk_rows, unit, keys), allowMissingColumns=True)
            part.append("_is_quote")  # quote rows never enter the trade frames
        # Explicit partition count: window work is CPU-heavy per byte, so AQE must not coalesce
        # this exchange by size. Ranges of (product, chunk) give every task about the same rows
        # and keep a product's neighbouring chunks together for the partitioned write.
        h = h.repartitionByRange(n, *keys, "_chunk")
        if quotes is not None:  # first, while the rows that it sorts are narrow
            h = W.with_columns(h, Q.chunk_quote_columns(keys))
        out = (W.stepped_windows(h, W.halo_window(part), with_leads)
               .filter(F.col("_own"))
               .drop("_chunk", "_own", "_is_quote", "minute_ts"))
        out = out.withColumnRenamed("_r", index_col) if index_col else out.drop("_r")
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    out = W.with_columns(out, W.derived_columns(with_leads))
    return out.drop(*[c for c in out.columns if c.startswith("_lag_")])


def final_filter(df: DataFrame) -> DataFrame:
    """F9 as the reference wrote it: keeps rows with a (partial-frame) 500-row mean and a
    10-ahead target. In effect drops the last 10 rows per product and rows with NULL price."""
    return df.filter(F.col("ma_500_trades").isNotNull() & F.col("target_return_10").isNotNull())


def lookback_filter(df: DataFrame, index_col: str, min_history: int = 500) -> DataFrame:
    """J4 (opt-in): keep trades with at least ``min_history`` rows of history including
    themselves (a full 500-row frame), using the per-product position ``index_col`` that
    ``build_features(index_col=...)`` keeps."""
    return df.filter(F.col(index_col) >= min_history - 1)


def trade_order(df: DataFrame, order_by: str = "event_ts", numeric_trade_id: bool = False
                ) -> tuple[DataFrame, list[str]]:
    """Ordering of trades inside a product (S6, S7). Default: envelope time, then trade id
    as TEXT (the reference). Options: the trade's own ``trade_time`` (S7), and trade ids
    compared as numbers, text order breaking ties among non-numeric ids (S6)."""
    order = []
    if order_by == "event_ts":
        order.append("event_ts_dt")
    elif order_by == "trade_time":
        df = df.withColumn("_trade_time_dt", utc_time("trade_time"))
        order.append("_trade_time_dt")
    else:
        raise ValueError(f"unknown order_by {order_by!r}")
    if numeric_trade_id:
        df = df.withColumn("_trade_id_num", F.col("trade_id").try_cast("bigint"))
        order.append("_trade_id_num")
    order.append("trade_id")
    return df, order


def feature_columns(trades_cols: Sequence[str]) -> list[str]:
    base = list(trades_cols) + (["event_ts_dt"] if "event_ts_dt" not in trades_cols else [])
    return (base + W.TRADE_FEATURE_ORDER + list(Q.QUOTE_COLUMNS)
            + list(Q.SPREAD_COLUMNS) + W.TARGET_ORDER)


def build_features(
    trades: DataFrame,
    ticker: DataFrame,
    strategy: str = "halo",
    chunk_rows: int | None = DEFAULT_CHUNK_ROWS,
    num_partitions: int | None = None,
    unit: str = "minute",
    apply_filter: bool = True,
    index_col: str | None = None,
    order_by: str = "event_ts",
    numeric_trade_id: bool = False,
    quote_join: str = "auto",
) -> DataFrame:
    """silver trades + silver ticker -> gold feature table (77 columns; one more
    with ``index_col``). ``order_by``/``numeric_trade_id``: see :func:`trade_order`.

    ``quote_join="window"`` (halo only) attaches the last quote of each minute inside the
    halo exchange, so the trades are not shuffled a third time for the join; ``"join"`` is
    a left join (AQE: broadcast when the measured quote side is small, else sort-merge);
    ``"auto"`` is ``"join"`` when the estimated quote side is under the broadcast threshold
    and ``"window"`` otherwise. No hint is given: AQE decides by the measured size."""
    trade_cols = trades.columns
    t, order = trade_order(parse_times(trades), order_by, numeric_trade_id)
    q = parse_times(ticker.select("product_id", "event_ts", "ingest_ts", *Q.QUOTE_COLUMNS))
    quotes = Q.last_per_bucket(q, unit=unit)
    if quote_join == "auto":
        # Catalyst's estimate comes from compressed files, so it only picks the plan. Where the
        # quotes look large they travel to the trades' halo partitions instead of the trades
        # to a join.
        size, limit = estimated_bytes(quotes), broadcast_threshold(trades.sparkSession)
        small = size is not None and 0 <= size <= limit
        quote_join = "join" if (small or strategy != "halo") else "window"
    if strategy == "halo" and quote_join == "window":
        joined = trade_features(t, strategy=strategy, chunk_rows=chunk_rows, num_partitions=num_partitions,
                                index_col=index_col, order=order, quotes=quotes, unit=unit)
    elif quote_join in ("join", "window"):
        feats = trade_features(t, strategy=strategy, chunk_rows=chunk_rows, num_partitions=num_partitions,
                               index_col=index_col, order=order)
        joined = Q.attach_quotes(feats, quotes, unit=unit)
    else:
        raise ValueError(f"unknown quote_join {quote_join!r}")
    cols = feature_columns(trade_cols) + ([index_col] if index_col else [])
    out = W.with_columns(joined, Q.spread_features()).select(*cols)
    return final_filter(out) if apply_filter else out


def feature_metrics(trades: DataFrame, ticker: DataFrame, unfiltered: DataFrame) -> DataFrame:
    """the reference's audit counts as one long table (metric, value), computed by
    aggregations (each partial before its shuffle) instead of driver-side count() calls."""
    keep: Column = F.col("ma_500_trades").isNotNull() & F.col("target_return_10").isNotNull()
    counts = unfiltered.agg(
        F.count(F.lit(1)).alias("before_filter"),
        F.count(F.when(keep, F.lit(1))).alias("after_filter"),
    )
    long = counts.select(F.expr(
        "stack(3, 'records_before_filter', before_filter, 'records_after_filter', after_filter, "
        "'records_removed', before_filter - after_filter) AS (metric, value)"))
    n_trades = trades.agg(F.count(F.lit(1)).alias("value")).select(F.lit("input_trades").alias("metric"), "value")
    n_ticker = ticker.agg(F.count(F.lit(1)).alias("value")).select(F.lit("input_ticker").alias("metric"), "value")
    return n_trades.unionByName(n_ticker).unionByName(long)
