"""Domain tables derived from the driver's ``events`` test table (see FIXTURES.md §3).

``events(event_id, ts, user_id, event_type, value, props)`` becomes a silver-shaped trades
table (every non-``view`` event), a silver-shaped ticker table (``view`` events) and the raw
JSON messages that feed routing and bronze. All work is plain DataFrame code, so the derived
tables grow with ``events``.

Fixed values (the mapping the SQL oracles repeat): product 'BTC-USD' for even user ids else
'ETH-USD'; price = round(value * 100) (integer cents, so sums are exact); trade size = props.k;
side 'SELL' when event_id % 3 = 0 else 'BUY'; trades use the minute of ``ts`` as event time (one message per second of trades),
ticker rows the second (one ticker per message); ingest time = event time + 2 s; bid/ask = price -/+ 5, no ask when
event_id % 11 = 0. Malformed variants: price 'bad' when event_id % 97 = 0, no side when
event_id % 101 = 0, a non-JSON line per event_id % 499 = 0, an envelope without events per
event_id % 503 = 0; duplicates: every message whose sequence number (its smallest
event_id) % 10 = 0 is sent again 3600 s later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas as S
from marketlake.functions import bucket_time

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_MICROS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_MICROS_OFFSET = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _product(e: DataFrame) -> Column:
    return F.when(F.col("user_id") % 2 == 0, F.lit("BTC-USD")).otherwise(F.lit("ETH-USD"))


def _cents(e: DataFrame) -> Column:
    return F.round(F.col("value") * 100)


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("double")


def _stamps(t: Column, ingest_delay: str = "2 seconds") -> list[Column]:
    return [
        F.date_format(t, ISO_SECONDS).alias("event_ts"),
        F.date_format(t + F.expr(f"INTERVAL {ingest_delay}"), ISO_MICROS_OFFSET).alias("ingest_ts"),
        F.hour(t).alias("event_hour"),
        F.to_date(t).alias("event_date"),
    ]


def trades(events: DataFrame) -> DataFrame:
    """Silver-trades-shaped table (SILVER_TRADES columns) from the non-view events."""
    e = events.filter(F.col("event_type") != "view")
    t = bucket_time("minute", "ts")
    return e.select(
        F.lit(S.CHANNEL_TRADES).alias("channel"),
        *_stamps(t)[:2],
        F.lit(S.SOURCE_TAG).alias("source"),
        F.lit("update").alias("event_type"),
        F.hour(t).alias("event_hour"),
        F.col("event_id").cast("string").alias("trade_id"),
        _cents(e).alias("price"),
        _k().alias("size"),
        F.date_format("ts", ISO_MICROS_Z).alias("trade_time"),
        F.when(F.col("event_id") % 3 == 0, F.lit("SELL")).otherwise(F.lit("BUY")).alias("side"),
        F.to_date(t).alias("event_date"),
        _product(e).alias("product_id"),
    )


def ticker(events: DataFrame) -> DataFrame:
    """Silver-ticker-shaped table (SILVER_TICKER columns) from the view events."""
    e = events.filter(F.col("event_type") == "view")
    t = bucket_time("second", "ts")
    price = _cents(e)
    k = _k()
    return e.select(
        F.lit(S.CHANNEL_TICKER).alias("channel"),
        *_stamps(t)[:2],
        F.lit(S.SOURCE_TAG).alias("source"),
        F.hour(t).alias("event_hour"),
        price.alias("price"),
        (k * 1000).alias("volume_24h"),
        (price - 100).alias("low_24h"),
        (price + 100).alias("high_24h"),
        (price - 1000).alias("low_52w"),
        (price + 1000).alias("high_52w"),
        (k - 50).alias("price_change_24h"),
        (price - 5).alias("best_bid"),
        k.alias("best_bid_qty"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(price + 5).alias("best_ask"),
        (k + 1).alias("best_ask_qty"),
        F.to_date(t).alias("event_date"),
        _product(e).alias("product_id"),
    )


def _num_text(c: Column) -> Column:
    return c.cast("string")


def raw_messages(events: DataFrame, malformed: bool = False, duplicates: bool = False,
                 channel: str | None = None) -> DataFrame:
    """Raw feed messages, one JSON document per row in column ``value``.

    Trades: one message per (product_id, minute, second of ts) with the minute as envelope
    time; ticker: one message per row (event time = second of ts). ``ingest_ts`` and ``source`` are already stamped (as routing
    does), so the rows are what the bronze jobs read from their topics. ``channel`` keeps
    one channel only (what one topic holds); the malformed extras then carry that channel.
    """
    if channel == S.CHANNEL_TRADES:
        events = events.filter(F.col("event_type") != "view")
    elif channel == S.CHANNEL_TICKER:
        events = events.filter(F.col("event_type") == "view")
    e = events
    # with one channel wanted, the other channel's payload is not put together, sorted and shuffled beside it
    payloads = {c: item for c, item in ((S.CHANNEL_TICKER, "ticker"), (S.CHANNEL_TRADES, "trade")) if channel in (None, c)}
    is_trade = F.col("event_type") != "view"
    unit_t = F.when(is_trade, bucket_time("minute", "ts")).otherwise(bucket_time("second", "ts"))
    price = _cents(e)
    price_text = _num_text(price)
    if malformed:
        price_text = F.when(F.col("event_id") % 97 == 0, F.lit("bad")).otherwise(price_text)
    side = F.when(F.col("event_id") % 3 == 0, F.lit("SELL")).otherwise(F.lit("BUY"))
    if malformed:
        side = F.when(F.col("event_id") % 101 == 0, F.lit(None).cast("string")).otherwise(side)
    k = _k()
    ask = F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(price + 5)
    base = e.select(
        F.when(is_trade, F.lit(S.CHANNEL_TRADES)).otherwise(F.lit(S.CHANNEL_TICKER)).alias("channel"),
        _product(e).alias("product_id"),
        unit_t.alias("t"),
        F.second("ts").alias("_sec"),
        F.col("event_id"),
        F.struct(
            _product(e).alias("product_id"),
            F.col("event_id").cast("string").alias("trade_id"),
            price_text.alias("price"),
            _num_text(k).alias("size"),
            F.date_format("ts", ISO_MICROS_Z).alias("time"),
            side.alias("side"),
        ).alias("trade"),
        F.struct(
            F.lit("ticker").alias("type"),
            _product(e).alias("product_id"),
            price_text.alias("price"),
            _num_text(k * 1000).alias("volume_24_h"),
            _num_text(price - 100).alias("low_24_h"),
            _num_text(price + 100).alias("high_24_h"),
            _num_text(price - 1000).alias("low_52_w"),
            _num_text(price + 1000).alias("high_52_w"),
            _num_text(k - 50).alias("price_percent_chg_24_h"),
            _num_text(price - 5).alias("best_bid"),
            _num_text(k).alias("best_bid_quantity"),
            _num_text(ask).alias("best_ask"),
            _num_text(k + 1).alias("best_ask_quantity"),
        ).alias("ticker"),
    )
    # a ticker message carries one ticker (as the feed sends one per product); a trade
    # message batches the trades of one second (its envelope time stays the minute)
    msg_key = F.when(F.col("channel") == S.CHANNEL_TICKER, F.col("event_id")).otherwise(F.col("_sec")).alias("_msg")
    grouped = base.groupBy("channel", "product_id", "t", msg_key).agg(
        F.min("event_id").alias("sequence_num"),
        *(F.array_sort(F.collect_list(F.when(F.col("channel") == c, F.col(item)))).alias(f"{item}s") for c, item in payloads.items()),
    ).drop("_msg").withColumn("_late", F.lit(False))
    if duplicates:
        # whole messages sent again one hour later (same sequence number and payload); the messages are put together once
        sent = F.when(F.col("sequence_num") % 10 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        grouped = grouped.withColumn("_late", F.explode(sent))
    delay = F.when(F.col("_late"), F.expr("INTERVAL 3602 seconds")).otherwise(F.expr("INTERVAL 2 seconds"))
    # one event per message; the payload list of the other channel stays NULL and
    # to_json leaves NULL fields out
    event = F.struct(
        F.lit("update").alias("type"),
        *(F.when(F.col("channel") == c, F.col(f"{item}s")).alias(f"{item}s") for c, item in payloads.items()),
    )
    msg = F.to_json(
        F.struct(
            F.col("channel"),
            F.lit("").alias("client_id"),
            F.date_format("t", ISO_SECONDS).alias("timestamp"),
            F.col("sequence_num"),
            F.array(event).alias("events"),
            F.date_format(F.col("t") + delay, ISO_MICROS_OFFSET).alias("ingest_ts"),
            F.lit(S.SOURCE_TAG).alias("source"),
        )
    )
    out = grouped.select(msg.alias("value"))
    if malformed:
        junk = events.filter(F.col("event_id") % 499 == 0).select(
            F.concat(F.lit("not json "), F.col("event_id").cast("string")).alias("value"))
        empty = events.filter(F.col("event_id") % 503 == 0).select(
            F.to_json(F.struct(
                F.lit(channel or S.CHANNEL_TRADES).alias("channel"),
                F.lit("").alias("client_id"),
                F.date_format(bucket_time("minute", "ts"), ISO_SECONDS).alias("timestamp"),
                F.col("event_id").alias("sequence_num"),
                F.array().cast("array<string>").alias("events"),
                F.date_format(bucket_time("minute", "ts") + F.expr("INTERVAL 2 seconds"),
                              ISO_MICROS_OFFSET).alias("ingest_ts"),
                F.lit(S.SOURCE_TAG).alias("source"),
            )).alias("value"))
        out = out.unionByName(junk).unionByName(empty)
    return out
