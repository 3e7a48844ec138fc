"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables (via the fixture mapping in ``marketlake.sources.testdata``).

``ORACLES`` holds the DuckDB SQL of each query (same column names). Floating columns that
come from a standard deviation are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas as S
from marketlake.operators import quotes as Q
from marketlake.operators import windows as W
from marketlake.plans import features as G
from marketlake.plans import oracles as O
from marketlake.sources import testdata as TD

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _trades(spark: SparkSession, d: str) -> DataFrame:
    return TD.trades(TD.load_events(spark, d))


def _ticker(spark: SparkSession, d: str) -> DataFrame:
    return TD.ticker(TD.load_events(spark, d))


# what the window families use: keys, order, tie-breakers and the three measures
_WINDOW_INPUT = ("product_id", "trade_id", "event_ts", "ingest_ts", "trade_time", "price", "size", "side")


def _trade_feats(spark: SparkSession, d: str, **kw) -> DataFrame:
    return G.trade_features(G.parse_times(_trades(spark, d).select(*_WINDOW_INPUT)), **kw)


VOL_COLS = ("volatility_10", "volatility_50", "volatility_100")


def _round_vol(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in VOL_COLS if c in df.columns})


def _sql_cols(cols) -> str:
    return ", ".join(f"ROUND({c}, 6) AS {c}" if c in VOL_COLS else c for c in cols)


def _family(name: str, cols: tuple[str, ...], with_leads: bool = False, **kw) -> None:
    def q(spark: SparkSession, d: str) -> DataFrame:
        df = _trade_feats(spark, d, with_leads=with_leads, **kw)
        return _round_vol(df.select("product_id", "trade_id", *cols))
    sql = O.features_ctes() + f"SELECT product_id, trade_id, {_sql_cols(cols)} FROM gold"
    register(name, sql)(q)


# ---------------------------------------------------------------- gold window families
_family("rolling_price_mean", ("ma_10_trades", "ma_50_trades", "ma_100_trades", "ma_500_trades"))
_family("rolling_price_minmax_range", (
    "min_10_trades", "max_10_trades", "min_50_trades", "max_50_trades", "min_100_trades", "max_100_trades",
    "price_range_10", "price_range_50", "price_range_100"))
_family("rolling_price_volatility", VOL_COLS)
_family("price_change_lag", ("price_change_1", "price_change_5", "price_change_10", "price_change_50"))
_family("pct_return_lag", ("return_1", "return_10", "return_50", "return_100"))
_family("price_vs_ma", ("price_vs_ma_10", "price_vs_ma_50", "price_vs_ma_100"))
_family("rolling_volume", ("volume_10", "volume_50", "volume_100", "volume_ma_10", "volume_ma_50", "volume_ma_100"))
_family("volume_ratio", ("volume_ratio_10", "volume_ratio_50"))
_family("buy_sell_counts_ratio", ("buy_count_50", "sell_count_50", "buy_count_100", "sell_count_100",
                                  "buy_sell_ratio_50", "buy_sell_ratio_100"))
_family("buy_sell_volume_ratio", ("buy_volume_50", "sell_volume_50", "buy_volume_100", "sell_volume_100",
                                  "buy_volume_ratio_50", "buy_volume_ratio_100"))


@register("time_features", O.features_ctes() + "SELECT product_id, trade_id, event_ts_dt, hour_of_day, day_of_week, is_weekend, is_buy FROM gold")
def time_features(spark: SparkSession, d: str) -> DataFrame:
    """Map-only columns: a plain projection."""
    rows = W.with_columns(G.parse_times(_trades(spark, d)), W.time_features())
    return rows.select("product_id", "trade_id", "event_ts_dt", "hour_of_day", "day_of_week", "is_weekend", "is_buy")


_family("future_targets", ("future_price_10", "future_price_50", "target_return_10", "target_return_50"),
        with_leads=True)
_family("target_direction", ("target_return_10", "target_direction_10", "target_direction_50"), with_leads=True)
# Halo chunking with small chunks, so that many chunk edges fall inside the data.
_family("halo_rolling_mean", ("ma_10_trades", "ma_500_trades", "max_100_trades", "price_change_50",
                              "return_100", "volume_100", "buy_count_100", "future_price_10", "future_price_50"),
        with_leads=True, chunk_rows=512)
_family("plain_window_features", ("ma_50_trades", "ma_500_trades", "min_100_trades", "return_100",
                                  "sell_volume_100", "future_price_50"), with_leads=True, strategy="plain")


# ---------------------------------------------------------------- quotes and join

def _quotes(spark: SparkSession, d: str, unit: str) -> DataFrame:
    q = G.parse_times(_ticker(spark, d).select("product_id", "event_ts", "ingest_ts", *Q.QUOTE_COLUMNS))
    return Q.last_per_bucket(q, unit=unit)


@register("last_ticker_per_minute",
          f"WITH {O.TICKER_CTE},\n{O.quotes_cte('minute').strip()}\n"
          "SELECT product_id, minute_ts, best_bid, best_ask FROM quotes")
def last_ticker_per_minute(spark: SparkSession, d: str) -> DataFrame:
    return _quotes(spark, d, "minute")


def _joined(spark: SparkSession, d: str, unit: str) -> DataFrame:
    t = G.parse_times(_trades(spark, d))
    return Q.attach_quotes(t, _quotes(spark, d, unit), unit=unit)


def _join_sql(unit: str) -> str:
    return (f"WITH {O.TRADES_CTE},\n{O.TICKER_CTE},\n{O.quotes_cte(unit).strip()}\n"
            "SELECT t.product_id, t.trade_id, t.event_ts_dt, q.best_bid, q.best_ask FROM trades t "
            f"LEFT JOIN quotes q ON t.product_id = q.product_id AND date_trunc('{unit}', t.event_ts_dt) = q.minute_ts")


@register("ticker_left_join", _join_sql("minute"))
def ticker_left_join(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d, "minute").select("product_id", "trade_id", "event_ts_dt", *Q.QUOTE_COLUMNS)


@register("ticker_left_join_hour", _join_sql("hour"))
def ticker_left_join_hour(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d, "hour").select("product_id", "trade_id", "event_ts_dt", *Q.QUOTE_COLUMNS)


@register("spread_features", O.features_ctes() +
          "SELECT product_id, trade_id, best_bid, best_ask, bid_ask_spread, spread_pct, price_vs_bid, price_vs_ask FROM gold")
def spread_features(spark: SparkSession, d: str) -> DataFrame:
    j = _joined(spark, d, "minute")
    return j.withColumns(dict(Q.spread_features())).select(
        "product_id", "trade_id", *Q.QUOTE_COLUMNS, "bid_ask_spread", "spread_pct", "price_vs_bid", "price_vs_ask")


# ---------------------------------------------------------------- feature table

def _gold(spark: SparkSession, d: str, apply_filter: bool = True, **kw) -> DataFrame:
    return G.build_features(_trades(spark, d), _ticker(spark, d), apply_filter=apply_filter, **kw)


_GOLD_FILTER = "WHERE ma_500_trades IS NOT NULL AND target_return_10 IS NOT NULL"


def _gold_sql_cols() -> str:
    return _sql_cols(G.feature_columns([f.name for f in S.SILVER_TRADES.fields]))


@register("feature_table", O.features_ctes() + f"SELECT {_gold_sql_cols()} FROM gold {_GOLD_FILTER}")
def feature_table(spark: SparkSession, d: str) -> DataFrame:
    return _round_vol(_gold(spark, d))


@register("halo_feature_table", O.features_ctes() + f"SELECT {_gold_sql_cols()} FROM gold {_GOLD_FILTER}")
def halo_feature_table(spark: SparkSession, d: str) -> DataFrame:
    """The large-data path: default chunks, quotes attached inside the halo exchange."""
    return _round_vol(_gold(spark, d, quote_join="window"))


@register("final_filter", O.features_ctes() +
          f"SELECT product_id, trade_id, ma_500_trades, target_return_10 FROM gold {_GOLD_FILTER}")
def final_filter_q(spark: SparkSession, d: str) -> DataFrame:
    return _gold(spark, d).select("product_id", "trade_id", "ma_500_trades", "target_return_10")


@register("feature_metrics", O.features_ctes() + f"""
SELECT 'input_trades' AS metric, COUNT(*) AS value FROM trades
UNION ALL SELECT 'input_ticker', COUNT(*) FROM ticker
UNION ALL SELECT 'records_before_filter', COUNT(*) FROM gold
UNION ALL SELECT 'records_after_filter', COUNT(*) FROM gold {_GOLD_FILTER}
UNION ALL SELECT 'records_removed', (SELECT COUNT(*) FROM gold) - (SELECT COUNT(*) FROM gold {_GOLD_FILTER})""")
def feature_metrics(spark: SparkSession, d: str) -> DataFrame:
    trades, ticker = _trades(spark, d), _ticker(spark, d)
    unfiltered = G.build_features(trades, ticker, apply_filter=False)
    return G.feature_metrics(trades, ticker, unfiltered)


@register("lookback_filter", O.features_ctes() + """
SELECT product_id, trade_id, ma_500_trades FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY event_ts_dt ASC NULLS FIRST,
                               trade_id ASC NULLS FIRST) AS rn FROM gold) WHERE rn >= 500""")
def lookback_filter_q(spark: SparkSession, d: str) -> DataFrame:
    g = _gold(spark, d, apply_filter=False, index_col="trade_seq")
    return G.lookback_filter(g, index_col="trade_seq").select("product_id", "trade_id", "ma_500_trades")


# ---------------------------------------------------------------- ordering options

_ORDER_COLS = ("ma_10_trades", "ma_500_trades", "price_change_1", "return_10", "buy_count_50",
               "future_price_10", "target_return_50")


@register("numeric_trade_id_order", O.features_ctes(
    order="event_ts_dt ASC NULLS FIRST, TRY_CAST(trade_id AS BIGINT) ASC NULLS FIRST, trade_id ASC NULLS FIRST")
    + f"SELECT product_id, trade_id, {', '.join(_ORDER_COLS)} FROM gold")
def numeric_trade_id_order(spark: SparkSession, d: str) -> DataFrame:
    g = _gold(spark, d, apply_filter=False, numeric_trade_id=True)
    return g.select("product_id", "trade_id", *_ORDER_COLS)


@register("trade_time_order", O.features_ctes(order="trade_time_dt ASC NULLS FIRST, trade_id ASC NULLS FIRST")
          + f"SELECT product_id, trade_id, {', '.join(_ORDER_COLS)} FROM gold")
def trade_time_order(spark: SparkSession, d: str) -> DataFrame:
    g = _gold(spark, d, apply_filter=False, order_by="trade_time")
    return g.select("product_id", "trade_id", *_ORDER_COLS)
