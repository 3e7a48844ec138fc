"""Row-counted trade windows and the gold feature families built on them.

The reference orders each product's trades by ``(event_ts_dt, trade_id)`` and computes
row-framed aggregates, lags and leads over ``Window.partitionBy("product_id")``. That plan
puts every trade of a product into ONE task: with a hot product holding a third of all
rows it cannot scale. :func:`halo_chunks` removes the limit: it gives each trade its
global row number within its product, cuts the sequence into fixed-size chunks and copies
the few rows a chunk needs from its neighbours (``lookback`` rows before, ``lookahead``
after), so the same window expressions run on ``(product_id, chunk)`` partitions of
bounded size. Results equal the plain window exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketlake.functions import guarded_ratio, is_side, pct_change, pct_distance
from marketlake.session import materialize

# fixed values: frame lengths in rows, lag and lead distances of the feature table
MA_FRAMES = (10, 50, 100, 500)
MINMAX_FRAMES = (10, 50, 100)
VOL_FRAMES = (10, 50, 100)
CHANGE_LAGS = (1, 5, 10, 50)
RETURN_LAGS = (1, 10, 50, 100)
VOLUME_FRAMES = (10, 50, 100)
VOLUME_RATIO_FRAMES = (10, 50)
PRESSURE_FRAMES = (50, 100)
LEADS = (10, 50)

LOOKBACK = max(max(MA_FRAMES) - 1, max(RETURN_LAGS), max(CHANGE_LAGS))  # 499 rows
LOOKAHEAD = max(LEADS)  # 50 rows

ORDER_COLUMNS = ("event_ts_dt", "trade_id")


def trade_window(partition: Sequence[str] = ("product_id",), order: Sequence[str] = ORDER_COLUMNS) -> WindowSpec:
    """The reference window: per product, ascending time then trade id (NULLs first)."""
    return Window.partitionBy(*partition).orderBy(*order)


def frame(w: WindowSpec, n: int) -> WindowSpec:
    """The current row and the ``n - 1`` rows before it."""
    return w.rowsBetween(-(n - 1), 0)


# ---------------------------------------------------------------- feature families
# Each family returns (name, Column) pairs; "window" families only read window
# aggregates of the input columns, "derived" families read earlier outputs.

def rolling_mean(w: WindowSpec) -> list[tuple[str, Column]]:
    return [(f"ma_{n}_trades", F.avg("price").over(frame(w, n))) for n in MA_FRAMES]


def rolling_min_max(w: WindowSpec) -> list[tuple[str, Column]]:
    out = []
    for n in MINMAX_FRAMES:
        out.append((f"min_{n}_trades", F.min("price").over(frame(w, n))))
        out.append((f"max_{n}_trades", F.max("price").over(frame(w, n))))
    return out


def price_range() -> list[tuple[str, Column]]:
    return [(f"price_range_{n}", F.col(f"max_{n}_trades") - F.col(f"min_{n}_trades")) for n in MINMAX_FRAMES]


def rolling_volatility(w: WindowSpec) -> list[tuple[str, Column]]:
    return [(f"volatility_{n}", F.stddev_samp("price").over(frame(w, n))) for n in VOL_FRAMES]


def price_lags(w: WindowSpec) -> list[tuple[str, Column]]:
    """Hidden helper columns ``_lag_k``: price k rows back (each computed once)."""
    return [(f"_lag_{k}", F.lag("price", k).over(w)) for k in sorted(set(CHANGE_LAGS) | set(RETURN_LAGS))]


def price_change() -> list[tuple[str, Column]]:
    return [(f"price_change_{k}", F.col("price") - F.col(f"_lag_{k}")) for k in CHANGE_LAGS]


def pct_return() -> list[tuple[str, Column]]:
    return [
        (f"return_{k}",
         F.when(F.col(f"_lag_{k}").isNotNull(), pct_change("price", f"_lag_{k}")).otherwise(F.lit(0.0)))
        for k in RETURN_LAGS
    ]


def price_vs_ma() -> list[tuple[str, Column]]:
    return [(f"price_vs_ma_{n}", pct_distance("price", f"ma_{n}_trades")) for n in (10, 50, 100)]


def rolling_volume(w: WindowSpec) -> list[tuple[str, Column]]:
    out = [(f"volume_{n}", F.sum("size").over(frame(w, n))) for n in VOLUME_FRAMES]
    out += [(f"volume_ma_{n}", F.avg("size").over(frame(w, n))) for n in VOLUME_FRAMES]
    return out


def volume_ratio() -> list[tuple[str, Column]]:
    return [(f"volume_ratio_{n}", guarded_ratio("size", f"volume_ma_{n}")) for n in VOLUME_RATIO_FRAMES]


def side_counts(w: WindowSpec) -> list[tuple[str, Column]]:
    out = []
    for n in PRESSURE_FRAMES:
        out.append((f"buy_count_{n}", F.sum(is_side("side", "BUY")).over(frame(w, n))))
        out.append((f"sell_count_{n}", F.sum(is_side("side", "SELL")).over(frame(w, n))))
    return out


def side_count_ratio() -> list[tuple[str, Column]]:
    return [(f"buy_sell_ratio_{n}", guarded_ratio(f"buy_count_{n}", f"sell_count_{n}")) for n in PRESSURE_FRAMES]


def side_volumes(w: WindowSpec) -> list[tuple[str, Column]]:
    out = []
    for n in PRESSURE_FRAMES:
        for side, name in (("BUY", "buy"), ("SELL", "sell")):
            sized = F.when(F.col("side") == side, F.col("size")).otherwise(F.lit(0.0))
            out.append((f"{name}_volume_{n}", F.sum(sized).over(frame(w, n))))
    # reference column order: buy_50, sell_50, buy_100, sell_100
    return out


def side_volume_ratio() -> list[tuple[str, Column]]:
    return [(f"buy_volume_ratio_{n}", guarded_ratio(f"buy_volume_{n}", f"volume_{n}")) for n in PRESSURE_FRAMES]


def time_features(ts: str = "event_ts_dt") -> list[tuple[str, Column]]:
    dow = F.dayofweek(ts)
    return [
        ("hour_of_day", F.hour(ts)),
        ("day_of_week", dow),
        ("is_weekend", F.when(dow.isin(1, 7), F.lit(1)).otherwise(F.lit(0))),
        ("is_buy", is_side("side", "BUY")),
    ]


def future_prices(w: WindowSpec) -> list[tuple[str, Column]]:
    return [(f"future_price_{k}", F.lead("price", k).over(w)) for k in LEADS]


def future_targets() -> list[tuple[str, Column]]:
    out = []
    for k in LEADS:
        fut = F.col(f"future_price_{k}")
        out.append((f"target_return_{k}", F.when(fut.isNotNull(), pct_change(fut, "price"))))
    for k in LEADS:
        r = F.col(f"target_return_{k}")
        out.append((f"target_direction_{k}", F.when(r > 0, F.lit(1)).when(r < 0, F.lit(0))))
    return out


def window_columns(w: WindowSpec, with_leads: bool = True) -> list[tuple[str, Column]]:
    """Every windowed aggregate of the feature table over one window spec (one Window node)."""
    cols = (rolling_mean(w) + rolling_min_max(w) + rolling_volatility(w) + price_lags(w)
            + rolling_volume(w) + side_counts(w) + side_volumes(w))
    if with_leads:
        cols += future_prices(w)
    return cols


def _total(parts: Sequence[Column], empty: Column) -> Column:
    """Sum of partial sums, NULL (a part without values) left out; NULL when all parts are."""
    added = reduce(add, (F.coalesce(p, empty) for p in parts))
    return F.when(F.coalesce(*parts).isNotNull(), added)


def stepped_windows(df: DataFrame, w: WindowSpec, with_leads: bool = True) -> DataFrame:
    """The columns of :func:`window_columns`, the longer frames put together from shorter ones.

    Spark aggregates a sliding frame anew for every row, 660 rows a trade for the frames of 10, 50, 100 and 500.
    Here only the frames of 10 rows are aggregated; 50 rows are five frames of 10 that lie 10 rows apart, 100 are two of
    50, 500 five of 100, each fetched by lags over the same partitions and order (no further shuffle or sort). Parts are
    only added up, never subtracted, so a NULL, NaN or infinite price counts in its own frames only; squared
    deviations are merged about the common mean. A part reads no row outside the frame it serves, so lookback halos stay as long."""
    price, size, zero = F.col("price"), F.col("size"), F.lit(0.0)
    sums = {"price": price, "size": size}
    for side, name in (("BUY", "buy"), ("SELL", "sell")):
        sums[f"{name}_volume"] = F.when(F.col("side") == side, size).otherwise(zero)
        sums[f"{name}_count"] = is_side("side", side)
    f = frame(w, MA_FRAMES[0])
    cols = price_lags(w) + (future_prices(w) if with_leads else [])
    cols += [(f"_sum_{c}_10", F.sum(v).over(f)) for c, v in sums.items()]
    cols += [(f"_n_{c}_10", F.count(c).over(f)) for c in ("price", "size")]
    cols += [("min_10_trades", F.min("price").over(f)), ("max_10_trades", F.max("price").over(f)), ("_var_10", F.var_samp("price").over(f))]
    df = with_columns(df, cols)
    df = with_columns(df, [("_m2_10", F.coalesce(F.col("_var_10") * (F.col("_n_price_10") - 1), zero)), ("volatility_10", F.sqrt("_var_10"))])

    for long, short in ((50, 10), (100, 50), (500, 100)):
        wanted = [*(f"_sum_{c}" for c in sums), "_n_price", "_n_size", "_m2"] if long <= 100 else ["_sum_price", "_n_price"]
        names = {f"{c}_{short}": f"{c}_{long}" for c in wanted}
        if long <= 100:
            names |= {f"{c}_{short}_trades": f"{c}_{long}_trades" for c in ("min", "max")}
        steps = range(short, long, short)
        df = with_columns(df, [(f"_{k}_back_{c}", F.lag(c, k).over(w)) for k in steps for c in names])
        parts = {c: [F.col(c), *(F.col(f"_{k}_back_{c}") for k in steps)] for c in names}
        cols = []
        for c, to in names.items():
            if c.startswith("min"):
                cols.append((to, F.least(*parts[c])))
            elif c.startswith("max"):
                cols.append((to, F.greatest(*parts[c])))
            elif not c.startswith("_m2"):
                cols.append((to, _total(parts[c], F.lit(0) if "_n_" in c or "_count" in c else zero)))
        df = with_columns(df, cols)
        if long <= 100:
            df = with_columns(df, [("_mean", F.try_divide(f"_sum_price_{long}", f"_n_price_{long}"))])
            apart = [F.coalesce(n * F.pow(F.try_divide(s, n) - F.col("_mean"), F.lit(2)), zero)
                     for s, n in zip(parts[f"_sum_price_{short}"], parts[f"_n_price_{short}"], strict=True)]
            within = [F.coalesce(p, zero) for p in parts[f"_m2_{short}"]]
            df = with_columns(df, [(f"_m2_{long}", reduce(add, within + apart))])
            df = with_columns(df, [(f"volatility_{long}", F.when(F.col(f"_n_price_{long}") > 1, F.sqrt(F.try_divide(f"_m2_{long}", F.col(f"_n_price_{long}") - 1))))])

    cols = [(f"ma_{n}_trades", F.try_divide(f"_sum_price_{n}", f"_n_price_{n}")) for n in MA_FRAMES]
    for n in VOLUME_FRAMES:
        cols += [(f"volume_{n}", F.col(f"_sum_size_{n}")), (f"volume_ma_{n}", F.try_divide(f"_sum_size_{n}", f"_n_size_{n}"))]
    for n in PRESSURE_FRAMES:
        cols += [(f"{name}_{what}_{n}", F.col(f"_sum_{name}_{what}_{n}")) for name in ("buy", "sell") for what in ("count", "volume")]
    df = with_columns(df, cols)
    helpers = ("_sum_", "_n_", "_m2_", "_var_10", "_mean", *(f"_{k}_back_" for k in (10, 20, 30, 40, 50, 100, 200, 300, 400)))
    return df.drop(*[c for c in df.columns if c.startswith(helpers)])


def derived_columns(with_targets: bool = True) -> list[tuple[str, Column]]:
    cols = (price_range() + price_change() + pct_return() + price_vs_ma() + volume_ratio()
            + side_count_ratio() + side_volume_ratio() + time_features())
    if with_targets:
        cols += future_targets()
    return cols


# fixed values: output order of the per-trade feature columns (E1..E51, then E56..E61)
TRADE_FEATURE_ORDER = (
    [f"ma_{n}_trades" for n in MA_FRAMES]
    + [x for n in MINMAX_FRAMES for x in (f"min_{n}_trades", f"max_{n}_trades")]
    + [f"price_range_{n}" for n in MINMAX_FRAMES]
    + [f"volatility_{n}" for n in VOL_FRAMES]
    + [f"price_change_{k}" for k in CHANGE_LAGS]
    + [f"return_{k}" for k in RETURN_LAGS]
    + [f"price_vs_ma_{n}" for n in (10, 50, 100)]
    + [f"volume_{n}" for n in VOLUME_FRAMES]
    + [f"volume_ma_{n}" for n in VOLUME_FRAMES]
    + [f"volume_ratio_{n}" for n in VOLUME_RATIO_FRAMES]
    + ["buy_count_50", "sell_count_50", "buy_count_100", "sell_count_100"]
    + [f"buy_sell_ratio_{n}" for n in PRESSURE_FRAMES]
    + ["buy_volume_50", "sell_volume_50", "buy_volume_100", "sell_volume_100"]
    + [f"buy_volume_ratio_{n}" for n in PRESSURE_FRAMES]
    + ["hour_of_day", "day_of_week", "is_weekend", "is_buy"]
)
TARGET_ORDER = (
    [f"future_price_{k}" for k in LEADS]
    + [f"target_return_{k}" for k in LEADS]
    + [f"target_direction_{k}" for k in LEADS]
)


def with_columns(df: DataFrame, pairs: list[tuple[str, Column]]) -> DataFrame:
    return df.withColumns(dict(pairs))


# ---------------------------------------------------------------- halo chunking

def row_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    num_partitions: int,
    index_col: str = "_r",
    checkpoint: bool = True,
    max_broadcast_rows: int = 2_000_000,
    stats: dict | None = None,
) -> DataFrame:
    """Add the 0-based position of each row within its ``keys`` group, in ``order``.

    One range shuffle sorts the data by ``(keys, order)``; a hot key spreads over many
    partitions because ``order`` is fine-grained. The row position inside each partition
    comes from ``monotonically_increasing_id`` after the local sort; the offsets that turn
    it into a per-key index come from a count table with one row per (partition, key)
    pair. The locally numbered rows are written once (``materialize``) so both uses read
    the same positions. Range partitions hold contiguous key ranges, so that table has at
    most ``num_partitions + #keys - 1`` rows: its size is bounded by the partition count
    and the number of products; it is counted and broadcast when under
    ``max_broadcast_rows``. ``order`` should be total (add tie breakers) so a recomputed
    partition gives every row the same position. ``stats`` (a dict) receives ``pairs`` (count
    table rows) and ``rows`` (total rows).
    """
    stats = {} if stats is None else stats
    # rows equal in all of these are interchangeable; the salt lets the range bounds part them
    # (malformed messages, say, are all equal), so no partition holds them all
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    sort_cols = [F.col(k).asc_nulls_first() for k in keys] + [F.col(c).asc_nulls_first() for c in order] + [F.col("_salt")]
    pid = F.spark_partition_id()
    local = (
        salted.repartitionByRange(num_partitions, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .select(*df.columns, pid.alias("_pid"),
                (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("_pos"))
    )
    if checkpoint:
        # Written to the shared checkpoint folder and read back: positions come from a
        # nondeterministic expression, so both uses below must read the same copy, and a
        # lost executor must not recompute them differently.
        local = materialize(local, "row-index")

    counts = local.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"))
    before_in_key = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    before_in_part = (
        Window.partitionBy("_pid").orderBy(*[F.col(k).asc_nulls_first() for k in keys])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        F.col("_pid").alias("_o_pid"),
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        (F.coalesce(F.sum("_n").over(before_in_key), F.lit(0))
         - F.coalesce(F.sum("_n").over(before_in_part), F.lit(0))).alias("_base"),
    )
    cond = [F.col("_pid") == F.col("_o_pid")] + [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    # Size check before the broadcast: one small job over two narrow columns of the
    # materialized table gives the count-table size (and the row total, for chunk sizing).
    # Beyond the limit (huge key cardinality) fall back to a shuffle join.
    if checkpoint or not stats:
        st = counts.agg(F.count(F.lit(1)).alias("pairs"), F.sum("_n").alias("rows")).collect()[0]
        stats.update(pairs=st["pairs"], rows=st["rows"] or 0)
    small = stats["pairs"] <= max_broadcast_rows
    joined = local.join(F.broadcast(offsets) if small else offsets, on=cond, how="inner")
    return joined.select(*df.columns, (F.col("_base") + F.col("_pos")).alias(index_col))


def auto_chunk_rows(total_rows: int, num_partitions: int, lo: int = 4096, hi: int = 65536, per_task: int = 4) -> int:
    """About ``per_task`` chunks per window task, so that range placement can even them out,
    within [lo, hi] rows: the halo share ((499 + 50) / chunk) stays under 14 % for small
    inputs and under 1 % for large ones."""
    want = -(-int(total_rows) // max(1, num_partitions * per_task))
    return int(min(hi, max(lo, want, LOOKBACK, LOOKAHEAD)))


def halo_chunks(
    indexed: DataFrame,
    chunk_rows: int,
    lookback: int = LOOKBACK,
    lookahead: int = LOOKAHEAD,
    index_col: str = "_r",
) -> DataFrame:
    """Assign rows to chunks of ``chunk_rows`` consecutive positions, with halo copies.

    Adds ``_chunk`` (the chunk this copy serves) and ``_own`` (true for the copy in the
    row's own chunk). A row is also copied to the next chunk when it lies in the last
    ``lookback`` positions of its chunk, and to the previous chunk when it lies in the first
    ``lookahead`` positions; with ``chunk_rows >= max(lookback, lookahead)`` one copy each
    way suffices. Extra rows: ``(lookback + lookahead) / chunk_rows`` of the input.
    """
    if chunk_rows < max(lookback, lookahead, 1):
        raise ValueError(f"chunk_rows={chunk_rows} must be >= max(lookback, lookahead)")
    r = F.col(index_col)
    c0 = F.floor(r / F.lit(chunk_rows)).cast("long")
    off = r - c0 * chunk_rows
    targets = F.array_compact(F.array(
        c0,
        F.when(off >= chunk_rows - lookback, c0 + 1) if lookback > 0 else F.lit(None).cast("long"),
        F.when((off < lookahead) & (c0 > 0), c0 - 1) if lookahead > 0 else F.lit(None).cast("long"),
    ))
    return (
        indexed.withColumn("_c0", c0)
        .withColumn("_chunk", F.explode(targets))
        .withColumn("_own", F.col("_chunk") == F.col("_c0"))
        .drop("_c0")
    )


def halo_window(keys: Sequence[str] = ("product_id",), index_col: str = "_r") -> WindowSpec:
    return Window.partitionBy(*keys, "_chunk").orderBy(index_col)
