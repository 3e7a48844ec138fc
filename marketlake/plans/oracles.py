"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on the driver's pre-registered views (``events`` etc.). The fixture
mapping of FIXTURES.md §3 is repeated as CTEs. Engine differences handled here: DuckDB
sorts NULLs last (Spark first) -> explicit NULLS FIRST; ``dayofweek`` is 0-based -> +1;
integer SUM is HUGEINT -> CAST BIGINT; x/0 -> NULLIF; stddev rounded to 6 digits on both
sides (the engines sum in different orders).
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixture CTEs

TRADES_CTE = """
trades AS (
  SELECT 'market_trades' AS channel,
         strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%SZ') AS event_ts,
         strftime(date_trunc('minute', ts) + INTERVAL 2 SECOND, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingest_ts,
         'ws_public' AS source,
         'update' AS event_type,
         CAST(hour(date_trunc('minute', ts)) AS INTEGER) AS event_hour,
         CAST(event_id AS VARCHAR) AS trade_id,
         ROUND(value * 100) AS price,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS trade_time,
         CASE WHEN event_id % 3 = 0 THEN 'SELL' ELSE 'BUY' END AS side,
         CAST(date_trunc('minute', ts) AS DATE) AS event_date,
         CASE WHEN user_id % 2 = 0 THEN 'BTC-USD' ELSE 'ETH-USD' END AS product_id,
         date_trunc('minute', ts) AS event_ts_dt,
         ts AS trade_time_dt
  FROM events WHERE event_type <> 'view'
)"""

TICKER_CTE = """
ticker AS (
  SELECT 'ticker' AS channel,
         strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS event_ts,
         strftime(date_trunc('second', ts) + INTERVAL 2 SECOND, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingest_ts,
         'ws_public' AS source,
         CAST(hour(date_trunc('second', ts)) AS INTEGER) AS event_hour,
         ROUND(value * 100) AS price,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) * 1000 AS volume_24h,
         ROUND(value * 100) - 100 AS low_24h,
         ROUND(value * 100) + 100 AS high_24h,
         ROUND(value * 100) - 1000 AS low_52w,
         ROUND(value * 100) + 1000 AS high_52w,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) - 50 AS price_change_24h,
         ROUND(value * 100) - 5 AS best_bid,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS best_bid_qty,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE ROUND(value * 100) + 5 END AS best_ask,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1 AS best_ask_qty,
         CAST(date_trunc('second', ts) AS DATE) AS event_date,
         CASE WHEN user_id % 2 = 0 THEN 'BTC-USD' ELSE 'ETH-USD' END AS product_id,
         date_trunc('second', ts) AS event_ts_dt
  FROM events WHERE event_type = 'view'
)"""

# ---------------------------------------------------------------- gold features

DEFAULT_ORDER = "event_ts_dt ASC NULLS FIRST, trade_id ASC NULLS FIRST"


def _spec(order: str) -> str:
    return f"PARTITION BY product_id ORDER BY {order}"


def _rows(n: int, order: str = DEFAULT_ORDER) -> str:
    return f"OVER ({_spec(order)} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _lag(k: int, order: str = DEFAULT_ORDER) -> str:
    return f"LAG(price, {k}) OVER ({_spec(order)})"


def _lead(k: int, order: str = DEFAULT_ORDER) -> str:
    return f"LEAD(price, {k}) OVER ({_spec(order)})"


def _pos_ratio(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN {num} / {den} ELSE 0.0 END"


def _pct_dist(v: str, ref: str) -> str:
    return f"CASE WHEN {ref} IS NOT NULL AND {ref} > 0 THEN ({v} - {ref}) / {ref} * 100 ELSE 0.0 END"


def windowed(order: str = DEFAULT_ORDER) -> str:
    return ",\n".join(
        [f"AVG(price) {_rows(n, order)} AS ma_{n}_trades" for n in (10, 50, 100, 500)]
        + [f"{fn}(price) {_rows(n, order)} AS {fn.lower()}_{n}_trades" for n in (10, 50, 100) for fn in ("MIN", "MAX")]
        + [f"STDDEV_SAMP(price) {_rows(n, order)} AS volatility_{n}" for n in (10, 50, 100)]
        + [f"{_lag(k, order)} AS lag_{k}" for k in (1, 5, 10, 50, 100)]
        + [f"SUM(size) {_rows(n, order)} AS volume_{n}" for n in (10, 50, 100)]
        + [f"AVG(size) {_rows(n, order)} AS volume_ma_{n}" for n in (10, 50, 100)]
        + [f"CAST(SUM(CASE WHEN side = '{s}' THEN 1 ELSE 0 END) {_rows(n, order)} AS BIGINT) AS {s.lower()}_count_{n}"
           for n in (50, 100) for s in ("BUY", "SELL")]
        + [f"SUM(CASE WHEN side = '{s}' THEN size ELSE 0.0 END) {_rows(n, order)} AS {s.lower()}_volume_{n}"
           for n in (50, 100) for s in ("BUY", "SELL")]
        + [f"{_lead(k, order)} AS future_price_{k}" for k in (10, 50)]
    )


DERIVED = ",\n".join(
    [f"max_{n}_trades - min_{n}_trades AS price_range_{n}" for n in (10, 50, 100)]
    + [f"price - lag_{k} AS price_change_{k}" for k in (1, 5, 10, 50)]
    + [f"CASE WHEN lag_{k} IS NOT NULL THEN ((price - lag_{k}) / NULLIF(lag_{k}, 0)) * 100 ELSE 0.0 END AS return_{k}"
       for k in (1, 10, 50, 100)]
    + [f"{_pct_dist('price', f'ma_{n}_trades')} AS price_vs_ma_{n}" for n in (10, 50, 100)]
    + [f"{_pos_ratio('size', f'volume_ma_{n}')} AS volume_ratio_{n}" for n in (10, 50)]
    + [f"{_pos_ratio(f'CAST(buy_count_{n} AS DOUBLE)', f'sell_count_{n}')} AS buy_sell_ratio_{n}" for n in (50, 100)]
    + [f"{_pos_ratio(f'buy_volume_{n}', f'volume_{n}')} AS buy_volume_ratio_{n}" for n in (50, 100)]
    + ["CAST(hour(event_ts_dt) AS INTEGER) AS hour_of_day",
       "CAST(dayofweek(event_ts_dt) + 1 AS INTEGER) AS day_of_week",
       "CASE WHEN dayofweek(event_ts_dt) + 1 IN (1, 7) THEN 1 ELSE 0 END AS is_weekend",
       "CASE WHEN side = 'BUY' THEN 1 ELSE 0 END AS is_buy"]
    + [f"CASE WHEN future_price_{k} IS NOT NULL THEN ((future_price_{k} - price) / NULLIF(price, 0)) * 100 END "
       f"AS target_return_{k}" for k in (10, 50)]
)

DIRECTIONS = ",\n".join(
    f"CASE WHEN target_return_{k} > 0 THEN 1 WHEN target_return_{k} < 0 THEN 0 END AS target_direction_{k}"
    for k in (10, 50)
)


def quotes_cte(unit: str = "minute") -> str:
    return f"""
quotes AS (
  SELECT product_id, minute_ts, best_bid, best_ask FROM (
    SELECT product_id, date_trunc('{unit}', event_ts_dt) AS minute_ts, best_bid, best_ask,
           ROW_NUMBER() OVER (PARTITION BY product_id, date_trunc('{unit}', event_ts_dt)
                              ORDER BY event_ts_dt DESC NULLS LAST, ingest_ts DESC NULLS LAST,
                                       best_bid DESC NULLS LAST, best_ask DESC NULLS LAST) AS rn
    FROM ticker) WHERE rn = 1
)"""


SPREAD = ",\n".join([
    "CASE WHEN best_ask IS NOT NULL AND best_bid IS NOT NULL THEN best_ask - best_bid ELSE 0.0 END AS bid_ask_spread",
    "CASE WHEN best_bid IS NOT NULL AND best_bid > 0 THEN ((best_ask - best_bid) / best_bid) * 100 ELSE 0.0 END AS spread_pct",
    f"{_pct_dist('price', 'best_bid')} AS price_vs_bid",
    f"{_pct_dist('price', 'best_ask')} AS price_vs_ask",
])


def features_ctes(unit: str = "minute", order: str = DEFAULT_ORDER) -> str:
    """CTEs up to ``gold`` (unfiltered, all 77 columns + helper lags)."""
    return f"""WITH {TRADES_CTE},
{TICKER_CTE},
fw AS (SELECT *, {windowed(order)} FROM trades),
fd AS (SELECT *, {DERIVED} FROM fw),
ft AS (SELECT *, {DIRECTIONS} FROM fd),
{quotes_cte(unit).strip()},
fj AS (SELECT ft.*, quotes.best_bid, quotes.best_ask FROM ft LEFT JOIN quotes
       ON ft.product_id = quotes.product_id AND date_trunc('{unit}', ft.event_ts_dt) = quotes.minute_ts),
gold AS (SELECT *, {SPREAD} FROM fj)
"""
