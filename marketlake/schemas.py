"""Explicit schemas of the raw messages and of every lake table.

Fixed values: field names and types below must equal the exchange feed's message layout
and the lake's table layout, so they are stated plainly.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


# ---- fixed values: channel names, origin tag, product subscription, topics ----
CHANNEL_TICKER = "ticker"
CHANNEL_TRADES = "market_trades"
SOURCE_TAG = "ws_public"
TOPIC_TICKER = "crypto.ticker.raw"
TOPIC_TRADES = "crypto.trades.raw"

# ---- fixed values: payload fields of one ticker and one trade (all strings on the wire) ----
TICKER_FIELDS = (
    "type", "product_id", "price", "volume_24_h", "low_24_h", "high_24_h", "low_52_w",
    "high_52_w", "price_percent_chg_24_h", "best_bid", "best_bid_quantity", "best_ask",
    "best_ask_quantity",
)
TRADE_FIELDS = ("product_id", "trade_id", "price", "size", "time", "side")

TICKER_ITEM = StructType(_strings(*TICKER_FIELDS))
TRADE_ITEM = StructType(_strings(*TRADE_FIELDS))


def _envelope(event: StructType) -> StructType:
    return StructType(
        _strings("channel", "client_id", "timestamp")
        + [StructField("sequence_num", LongType(), True),
           StructField("events", ArrayType(event, True), True)]
        + _strings("ingest_ts", "source")
    )


TICKER_EVENT = StructType(_strings("type") + [StructField("tickers", ArrayType(TICKER_ITEM, True), True)])
TRADES_EVENT = StructType(_strings("type") + [StructField("trades", ArrayType(TRADE_ITEM, True), True)])

TICKER_MESSAGE = _envelope(TICKER_EVENT)
TRADES_MESSAGE = _envelope(TRADES_EVENT)

# Union of both channels: used by routing, which must look at either payload.
ANY_EVENT = StructType(
    _strings("type")
    + [StructField("tickers", ArrayType(TICKER_ITEM, True), True),
       StructField("trades", ArrayType(TRADE_ITEM, True), True)]
)
ANY_MESSAGE = _envelope(ANY_EVENT)

# ---- lake tables ----
BRONZE_TICKER = StructType(
    list(TICKER_MESSAGE.fields)
    + [StructField("event_hour", IntegerType(), True), StructField("event_date", DateType(), True)]
)

BRONZE_TRADES = StructType(
    _strings("channel", "timestamp", "ingest_ts", "source", "event_type", "product_id", "trade_id")
    + [StructField("price", DoubleType(), True), StructField("size", DoubleType(), True)]
    + _strings("trade_time", "side")
    + [StructField("event_hour", IntegerType(), True), StructField("event_date", DateType(), True)]
)

# fixed values: ticker payload field -> silver column (all cast to double)
TICKER_NUMERIC_COLUMNS = (
    ("price", "price"),
    ("volume_24_h", "volume_24h"),
    ("low_24_h", "low_24h"),
    ("high_24_h", "high_24h"),
    ("low_52_w", "low_52w"),
    ("high_52_w", "high_52w"),
    ("price_percent_chg_24_h", "price_change_24h"),
    ("best_bid", "best_bid"),
    ("best_bid_quantity", "best_bid_qty"),
    ("best_ask", "best_ask"),
    ("best_ask_quantity", "best_ask_qty"),
)

SILVER_TICKER = StructType(
    _strings("channel", "event_ts", "ingest_ts", "source")
    + [StructField("event_hour", IntegerType(), True)]
    + [StructField(name, DoubleType(), True) for _, name in TICKER_NUMERIC_COLUMNS]
    + [StructField("event_date", DateType(), True), StructField("product_id", StringType(), True)]
)

SILVER_TRADES = StructType(
    _strings("channel", "event_ts", "ingest_ts", "source", "event_type")
    + [StructField("event_hour", IntegerType(), True), StructField("trade_id", StringType(), True),
       StructField("price", DoubleType(), True), StructField("size", DoubleType(), True)]
    + _strings("trade_time", "side")
    + [StructField("event_date", DateType(), True), StructField("product_id", StringType(), True)]
)

MARK_SCHEMA = StructType(_strings("last_ingest_ts"))

# Partition layouts of the lake (outer first).
BRONZE_PARTITIONS = ("event_date",)
SILVER_PARTITIONS = ("event_date", "product_id")
GOLD_PARTITIONS = ("product_id", "event_date")

# What the routing stream keeps.
ROUTED = StructType(_strings("key", "value", "channel", "product_id", "topic"))
DEAD_LETTERS = StructType(_strings("value", "reason"))
