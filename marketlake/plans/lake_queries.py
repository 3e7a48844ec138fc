"""Registered queries for routing, bronze, silver, incremental loads, streams and quality.

Queries that exercise sinks and streams write to a fresh folder under the session's shared
checkpoint location (``spark.checkpoint.dir``) and return what they read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake import schemas as S
from marketlake.operators import bronze as B
from marketlake.operators import incremental as I
from marketlake.operators import quality as DQ
from marketlake.operators import routing as R
from marketlake.operators import silver as SV
from marketlake.plans import features as G
from marketlake.plans import increments as INC
from marketlake.plans import jobs as JOBS
from marketlake.plans import oracles as O
from marketlake.plans.queries import _GOLD_FILTER, _gold, _gold_sql_cols, _round_vol, register
from marketlake.session import materialize, scratch_dir
from marketlake.sources import commits as C
from marketlake.sources import lake as L
from marketlake.sources import testdata as TD
from marketlake.streaming import jobs as ST

ROUTE_STAMP = "2024-02-01T00:00:00.000000+00:00"
MARK = "2024-01-15T00:00:02.000000+00:00"

# ---------------------------------------------------------------- oracle building blocks

_EV = """
ev AS (
  SELECT *,
         CASE WHEN event_type <> 'view' THEN 'market_trades' ELSE 'ticker' END AS channel_x,
         CASE WHEN user_id % 2 = 0 THEN 'BTC-USD' ELSE 'ETH-USD' END AS product_x,
         CASE WHEN event_type <> 'view' THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END AS t,
         ROUND(value * 100) AS cents,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         CASE WHEN event_type <> 'view' THEN second(ts) ELSE event_id END AS msg_x
  FROM events
),
evs AS (
  SELECT *, MIN(event_id) OVER (PARTITION BY channel_x, product_x, t, msg_x) AS seq FROM ev
),
copies AS (
  SELECT evs.*, 2 AS delay_s FROM evs
  UNION ALL SELECT evs.*, 3602 AS delay_s FROM evs WHERE seq % 10 = 0 AND {dups}
)"""


def _ev(dups: bool) -> str:
    return _EV.format(dups="TRUE" if dups else "FALSE")


def _iso(t: str) -> str:
    return f"strftime({t}, '%Y-%m-%dT%H:%M:%SZ')"


def _ingest(t: str, delay: str = "delay_s") -> str:
    return f"strftime({t} + to_seconds({delay}), '%Y-%m-%dT%H:%M:%S.%f+00:00')"


def _price(malformed: bool) -> str:
    return "CASE WHEN event_id % 97 = 0 THEN NULL ELSE cents END" if malformed else "cents"


def _side(malformed: bool) -> str:
    base = "CASE WHEN event_id % 3 = 0 THEN 'SELL' ELSE 'BUY' END"
    return f"CASE WHEN event_id % 101 = 0 THEN NULL ELSE {base} END" if malformed else base


def bronze_trades_sql(malformed: bool, dups: bool, ts_name: str = "timestamp") -> str:
    rows = f"""
SELECT 'market_trades' AS channel, {_iso('t')} AS {ts_name}, {_ingest('t')} AS ingest_ts, 'ws_public' AS source,
       'update' AS event_type, product_x AS product_id, CAST(event_id AS VARCHAR) AS trade_id,
       {_price(malformed)} AS price, k AS size, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS trade_time,
       {_side(malformed)} AS side, CAST(hour(t) AS INTEGER) AS event_hour, CAST(t AS DATE) AS event_date
FROM copies WHERE event_type <> 'view'"""
    if malformed:
        m = "date_trunc('minute', ts)"
        rows += f"""
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), NULL, NULL,
       CAST(NULL AS INTEGER), CAST(NULL AS DATE)
FROM ev WHERE event_type <> 'view' AND event_id % 499 = 0
UNION ALL
SELECT 'market_trades', {_iso(m)}, {_ingest(m, '2')}, 'ws_public', NULL, NULL, NULL, CAST(NULL AS DOUBLE),
       CAST(NULL AS DOUBLE), NULL, NULL, CAST(hour({m}) AS INTEGER), CAST({m} AS DATE)
FROM ev WHERE event_type <> 'view' AND event_id % 503 = 0"""
    return rows


def silver_ticker_sql(malformed: bool, dups: bool, extra: str = "") -> str:
    return f"""
SELECT 'ticker' AS channel, {_iso('t')} AS event_ts, {_ingest('t')} AS ingest_ts, 'ws_public' AS source,
       CAST(hour(t) AS INTEGER) AS event_hour, {_price(malformed)} AS price, k * 1000 AS volume_24h,
       cents - 100 AS low_24h, cents + 100 AS high_24h, cents - 1000 AS low_52w, cents + 1000 AS high_52w,
       k - 50 AS price_change_24h, cents - 5 AS best_bid, k AS best_bid_qty,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE cents + 5 END AS best_ask, k + 1 AS best_ask_qty,
       {extra} CAST(t AS DATE) AS event_date, product_x AS product_id
FROM copies WHERE event_type = 'view'"""


def _with(dups: bool, body: str) -> str:
    return f"WITH {_ev(dups).strip()}\n{body}"


SILVER_TRADE_COLS = ("channel, event_ts, ingest_ts, source, event_type, event_hour, trade_id, price, size, "
                     "trade_time, side, event_date, product_id")


def _silver_trades_sql(malformed: bool, dups: bool, where: str = "") -> str:
    return _with(dups, f"SELECT {SILVER_TRADE_COLS} FROM ({bronze_trades_sql(malformed, dups, 'event_ts')}) b {where}")


# ---------------------------------------------------------------- Spark helpers

def _events(spark: SparkSession, d: str) -> DataFrame:
    return TD.load_events(spark, d)


def _raw(spark: SparkSession, d: str, channel: str | None, malformed: bool = True, dups: bool = False) -> DataFrame:
    return TD.raw_messages(_events(spark, d), malformed=malformed, duplicates=dups, channel=channel)


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


# ---------------------------------------------------------------- routing

@register("route_messages", _with(False, """
SELECT CASE channel_x WHEN 'ticker' THEN 'crypto.ticker.raw' ELSE 'crypto.trades.raw' END AS topic,
       product_x AS key, channel_x AS channel, product_x AS product_id,
       strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS msg_timestamp, MIN(event_id) AS sequence_num,
       COUNT(*) AS items, '2024-02-01T00:00:00.000000+00:00' AS ingest_ts, 'ws_public' AS source
FROM ev GROUP BY channel_x, product_x, t, msg_x"""))
def route_messages(spark: SparkSession, d: str) -> DataFrame:
    routed = R.route_messages(_raw(spark, d, None), ingest_ts=ROUTE_STAMP)
    v = F.col("value")
    items = F.coalesce(F.json_array_length(F.get_json_object(v, "$.events[0].trades")),
                       F.json_array_length(F.get_json_object(v, "$.events[0].tickers")))
    return routed.select(
        "topic", "key", "channel", "product_id",
        F.get_json_object(v, "$.timestamp").alias("msg_timestamp"),
        F.get_json_object(v, "$.sequence_num").cast("bigint").alias("sequence_num"),
        items.cast("bigint").alias("items"),
        F.get_json_object(v, "$.ingest_ts").alias("ingest_ts"),
        F.get_json_object(v, "$.source").alias("source"),
    )


@register("route_whole_message", _with(False, """
SELECT CASE channel_x WHEN 'ticker' THEN 'crypto.ticker.raw' ELSE 'crypto.trades.raw' END AS topic, product_x AS key,
       strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS msg_timestamp, MIN(event_id) AS sequence_num, '{"n":[1,"1"]}' AS extra, TRUE AS note_kept
FROM ev WHERE product_x = 'BTC-USD' GROUP BY channel_x, product_x, t, msg_x"""))
def route_whole_message(spark: SparkSession, d: str) -> DataFrame:
    """Messages as bytes, with an unknown field and an explicit null (B8, C1), among copies with a
    foreign channel (B2) and with an empty product id (B4); one product is subscribed (B9)."""
    raw = _raw(spark, d, None)
    foreign = raw.select(F.regexp_replace("value", '"channel":"[a-z_]+"', '"channel":"heartbeats"').alias("value"))
    unnamed = raw.select(F.regexp_replace("value", '"product_id":"[^"]*"', '"product_id":""').alias("value"))
    marked = F.regexp_replace("value", r"^\{", '{"extra":{"n":[1,"1"]},"note":null,')
    every = raw.unionByName(foreign).unionByName(unnamed).select(marked.cast("binary").alias("value"))
    routed = R.route_messages(every, ingest_ts=ROUTE_STAMP, products=("BTC-USD",))
    v = F.col("value")
    return routed.select("topic", "key", F.get_json_object(v, "$.timestamp").alias("msg_timestamp"),
                         F.get_json_object(v, "$.sequence_num").cast("bigint").alias("sequence_num"),
                         F.get_json_object(v, "$.extra").alias("extra"), F.contains(v, F.lit('"note":null')).alias("note_kept"))


@register("dead_letters", _with(False, """
, n AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT channel_x, product_x, t, msg_x FROM ev)),
 b AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT channel_x, product_x, t, msg_x FROM ev WHERE product_x = 'BTC-USD'))
SELECT r AS outcome, CASE r WHEN 'routed' THEN b.n WHEN 'not_subscribed' THEN n.n - b.n ELSE n.n END AS messages
FROM n, b, (SELECT unnest(['routed', 'not_subscribed', 'other_channel', 'no_product', 'not_json', 'no_channel']) AS r)"""))
def dead_letters(spark: SparkSession, d: str) -> DataFrame:
    """Every message five times, four times broken in a way of its own, routed as a stream with a restart:
    messages routed and dropped by reason, read back from the two tables."""
    root = _scratch(spark, "dead-letters")
    for step in range(2):
        if step == 0:
            part = _raw(spark, d, None, malformed=False)
        else:  # the broken ones are made from the archived messages, not from messages put together four times more
            raw = L.text_batch(spark, f"{root}/raw")
            breaks = [F.regexp_replace("value", '"channel":"[a-z_]+"', '"channel":"heartbeats"'), F.regexp_replace("value", '"product_id":"[^"]*"', '"product_id":""'),
                      F.expr("substr(value, 2)"), F.regexp_replace("value", '"channel":"[a-z_]+"', '"chanel":"x"')]
            part = raw.select(F.explode(F.array(*breaks)).alias("value"))
        part.write.mode("append").option("compression", "gzip").text(f"{root}/raw")
        q = ST.start_routing(L.text_stream(spark, f"{root}/raw"), f"{root}/routed", f"{root}/dropped", f"{root}/ckpt", available_now=True,
                             ingest_ts=ROUTE_STAMP, products=("BTC-USD",))
        ST.run_until_idle(q)
    kept = C.read_committed(spark, f"{root}/routed", S.ROUTED).select(F.lit("routed").alias("outcome"))
    dropped = C.read_committed(spark, f"{root}/dropped", S.DEAD_LETTERS).select(F.col("reason").alias("outcome"))
    return kept.unionByName(dropped).groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


# ---------------------------------------------------------------- bronze (C*)

@register("bronze_trades_flatten", _with(False, bronze_trades_sql(True, False)))
def bronze_trades_flatten(spark: SparkSession, d: str) -> DataFrame:
    return B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES))


_BRONZE_TICKER_SQL = _with(False, """
SELECT 'ticker' AS channel, '' AS client_id, strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
       MIN(event_id) AS sequence_num, strftime(t + INTERVAL 2 SECOND, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingest_ts,
       'ws_public' AS source, CAST(hour(t) AS INTEGER) AS event_hour, CAST(t AS DATE) AS event_date,
       1 AS n_events, COUNT(*) AS n_tickers, product_x AS first_product
FROM ev WHERE event_type = 'view' GROUP BY product_x, t, msg_x
UNION ALL
SELECT NULL, NULL, NULL, CAST(NULL AS BIGINT), NULL, NULL, CAST(NULL AS INTEGER), CAST(NULL AS DATE),
       NULL, NULL, NULL
FROM ev WHERE event_type = 'view' AND event_id % 499 = 0
UNION ALL
SELECT 'ticker', '', strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%SZ'), event_id,
       strftime(date_trunc('minute', ts) + INTERVAL 2 SECOND, '%Y-%m-%dT%H:%M:%S.%f+00:00'), 'ws_public',
       CAST(hour(date_trunc('minute', ts)) AS INTEGER), CAST(date_trunc('minute', ts) AS DATE), 0, NULL, NULL
FROM ev WHERE event_type = 'view' AND event_id % 503 = 0""")


@register("bronze_ticker_parse", _BRONZE_TICKER_SQL)
def bronze_ticker_parse(spark: SparkSession, d: str) -> DataFrame:
    b = B.bronze_ticker(_raw(spark, d, S.CHANNEL_TICKER))
    first = F.get(F.col("events"), 0)
    return b.select(
        "channel", "client_id", "timestamp", "sequence_num", "ingest_ts", "source", "event_hour", "event_date",
        F.size("events").cast("int").alias("n_events"),
        F.size(first.getField("tickers")).cast("bigint").alias("n_tickers"),
        F.get(first.getField("tickers"), 0).getField("product_id").alias("first_product"),
    )


# ---------------------------------------------------------------- silver

@register("silver_ticker", _with(False, silver_ticker_sql(True, False)))
def silver_ticker_q(spark: SparkSession, d: str) -> DataFrame:
    return SV.silver_ticker(B.bronze_ticker(_raw(spark, d, S.CHANNEL_TICKER)))


@register("silver_trades", _silver_trades_sql(True, False))
def silver_trades_q(spark: SparkSession, d: str) -> DataFrame:
    return SV.silver_trades(B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES)))


@register("schema_enforced_silver", _silver_trades_sql(True, False))
def schema_enforced_silver(spark: SparkSession, d: str) -> DataFrame:
    silver = SV.silver_trades(B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES)))
    return SV.enforce_schema(silver.withColumn("unexpected", F.lit(1)), S.SILVER_TRADES)


# ---------------------------------------------------------------- incremental

@register("incremental_filter", _silver_trades_sql(False, True, f"WHERE ingest_ts > '{MARK}'"))
def incremental_filter(spark: SparkSession, d: str) -> DataFrame:
    bronze = B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES, malformed=False, dups=True))
    return SV.silver_trades(I.increment(bronze, MARK))


@register("max_ingest_mark", _with(True, f"""
SELECT MAX(ingest_ts) AS last_ingest_ts FROM ({bronze_trades_sql(True, True)}) b WHERE ingest_ts > '{MARK}'"""))
def max_ingest_mark(spark: SparkSession, d: str) -> DataFrame:
    bronze = B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES, malformed=True, dups=True))
    return I.max_mark(I.increment(bronze, MARK))


@register("incremental_load_roundtrip", _silver_trades_sql(False, True))
def incremental_load_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Bronze arrives in two parts; each incremental run appends only what is new; a third
    run with nothing new writes nothing. The silver table read back equals one full load."""
    root = _scratch(spark, "incremental")
    bronze_path, silver_path, state = f"{root}/bronze", f"{root}/silver", f"{root}/state"
    bronze = B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES, malformed=False, dups=True))
    L.write_table(bronze.filter(F.col("ingest_ts") <= MARK), bronze_path, S.BRONZE_PARTITIONS)
    runs = [I.incremental_append(spark, L.read_table(spark, bronze_path, S.BRONZE_TRADES),
                                 SV.silver_trades, silver_path, state)]
    L.write_table(bronze.filter(F.col("ingest_ts") > MARK), bronze_path, S.BRONZE_PARTITIONS)
    for _ in range(2):
        runs.append(I.incremental_append(spark, L.read_table(spark, bronze_path, S.BRONZE_TRADES),
                                         SV.silver_trades, silver_path, state))
    if not (runs[0]["written"] and runs[1]["written"] and not runs[2]["written"]
            and runs[1]["previous_mark"] == runs[0]["mark"] <= MARK < runs[1]["mark"] == runs[2]["mark"]):
        raise AssertionError(f"incremental runs out of order: {runs}")
    return L.read_table(spark, silver_path, S.SILVER_TRADES).select(*[f.name for f in S.SILVER_TRADES.fields])


# ---------------------------------------------------------------- streams

@register("bronze_stream_roundtrip", _with(False, bronze_trades_sql(True, False)))
def bronze_stream_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Raw trade messages as text files -> bronze stream (availableNow) run twice: the
    second run finds nothing new, so nothing is written twice."""
    root = _scratch(spark, "bronze-stream")
    _raw(spark, d, S.CHANNEL_TRADES).write.mode("overwrite").text(f"{root}/raw")
    for _ in range(2):
        q = ST.start_bronze(L.text_stream(spark, f"{root}/raw"), "trades", f"{root}/bronze",
                            f"{root}/ckpt", available_now=True)
        ST.run_until_idle(q)
    return L.read_table(spark, f"{root}/bronze", S.BRONZE_TRADES)


@register("silver_stream_dedup", _with(True, f"""
SELECT DISTINCT channel, event_ts, source, event_type, event_hour, trade_id, price, size, trade_time, side,
       event_date, product_id
FROM ({bronze_trades_sql(False, True, 'event_ts')}) b"""))
def silver_stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Bronze files (with one-hour-late duplicate messages) -> silver stream deduplicated on
    (product_id, trade_id) against what is stored; the checkpoint makes reruns exactly-once. ``ingest_ts`` is left out of the result: which copy survives is the
    first to arrive."""
    root = _scratch(spark, "silver-stream")
    bronze = B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES, malformed=False, dups=True))
    L.write_table(bronze, f"{root}/bronze", S.BRONZE_PARTITIONS)
    for _ in range(2):
        q = ST.start_silver(spark, f"{root}/bronze", "trades", f"{root}/silver", f"{root}/ckpt",
                            available_now=True, dedup=True)
        ST.run_until_idle(q)
    out = JOBS.read_lake(spark, f"{root}/silver", S.SILVER_TRADES)
    return out.select(*[f.name for f in S.SILVER_TRADES.fields if f.name != "ingest_ts"])


@register("silver_ticker_stream_dedup", _with(True, f"""
SELECT DISTINCT channel, event_ts, source, event_hour, price, volume_24h, low_24h, high_24h, low_52w, high_52w,
       price_change_24h, best_bid, best_bid_qty, best_ask, best_ask_qty, client_id, sequence_num, event_date,
       product_id
FROM ({silver_ticker_sql(False, True, "'' AS client_id, seq AS sequence_num,")}) s"""))
def silver_ticker_stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """J2 stream form: ticker bronze files with one-hour-late duplicate messages -> silver
    stream deduplicated on (product_id, sequence_num), several micro-batches."""
    root = _scratch(spark, "silver-ticker-stream")
    bronze = B.bronze_ticker(_raw(spark, d, S.CHANNEL_TICKER, malformed=False, dups=True))
    L.write_table(bronze, f"{root}/bronze", S.BRONZE_PARTITIONS)
    q = ST.start_silver(spark, f"{root}/bronze", "ticker", f"{root}/silver", f"{root}/ckpt",
                        available_now=True, dedup=True, max_files=40)
    ST.run_until_idle(q)
    fields = list(S.SILVER_TICKER.fields)
    fields[-2:-2] = [S.BRONZE_TICKER[c] for c in ("client_id", "sequence_num")]
    return JOBS.read_lake(spark, f"{root}/silver", S.StructType(fields)).drop("ingest_ts")


_DEDUPED_TRADES = f"""
SELECT DISTINCT channel, event_ts, source, event_type, event_hour, trade_id, price, size, trade_time, side, event_date, product_id
FROM ({bronze_trades_sql(False, True, 'event_ts')}) b"""


@register("silver_stream_dedup_late", _with(True, _DEDUPED_TRADES))
def silver_stream_dedup_late(spark: SparkSession, d: str) -> DataFrame:
    """Three runs of the stream: the newest half of bronze, then the re-sent messages, then the
    oldest half, all of it weeks late. Late rows stay, re-sent ones go, whenever they come."""
    root = _scratch(spark, "silver-late")
    bronze = B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES, malformed=False, dups=True))
    sent_again = F.col("ingest_ts") > F.date_format(F.to_timestamp("timestamp") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss")
    for part in (bronze.where(F.col("ingest_ts") > MARK).where(~sent_again), bronze.where(sent_again),
                 bronze.where(F.col("ingest_ts") <= MARK).where(~sent_again)):
        L.write_table(part, f"{root}/bronze", S.BRONZE_PARTITIONS)
        ST.run_until_idle(ST.start_silver(spark, f"{root}/bronze", "trades", f"{root}/silver", f"{root}/ckpt", dedup=True))
    out = JOBS.read_lake(spark, f"{root}/silver", S.SILVER_TRADES)
    return out.select(*[f.name for f in S.SILVER_TRADES.fields if f.name != "ingest_ts"])


@register("silver_job_dedup", _with(True, _DEDUPED_TRADES))
def silver_job_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Incremental loads with dedup against stored keys: re-sent messages come with the next load."""
    root = _scratch(spark, "silver-job")
    bronze = B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES, malformed=False, dups=True), ingest_date=True)
    for part in (bronze.where(F.col("ingest_ts") <= MARK), bronze.where(F.col("ingest_ts") > MARK)):
        L.write_table(part, f"{root}/bronze", ["ingest_date", *S.BRONZE_PARTITIONS])
        JOBS.silver_job(spark, "trades", f"{root}/bronze", f"{root}/silver", f"{root}/state", dedup=True, ingest_date=True)
    out = JOBS.read_lake(spark, f"{root}/silver", S.SILVER_TRADES)
    return out.select(*[f.name for f in S.SILVER_TRADES.fields if f.name != "ingest_ts"])


@register("silver_two_streams", _with(True, _DEDUPED_TRADES))
def silver_two_streams(spark: SparkSession, d: str) -> DataFrame:
    """Two streams with checkpoints of their own, whose bronze overlaps, into one silver table; then the
    first one again after its checkpoint was lost. Nothing is lost, nothing stored twice."""
    root = _scratch(spark, "two-streams")
    bronze = B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES, malformed=False, dups=True))
    L.write_table(bronze.where(F.col("ingest_ts") <= MARK), f"{root}/one", S.BRONZE_PARTITIONS)
    L.write_table(bronze.where(F.col("ingest_ts") > "2024-01-10"), f"{root}/two", S.BRONZE_PARTITIONS)
    for source, checkpoint in (("one", "a"), ("two", "b"), ("one", "c")):
        ST.run_until_idle(ST.start_silver(spark, f"{root}/{source}", "trades", f"{root}/silver", f"{root}/ckpt-{checkpoint}", dedup=True))
    return JOBS.read_lake(spark, f"{root}/silver", S.SILVER_TRADES).drop("ingest_ts")


@register("silver_compacted", _with(True, _DEDUPED_TRADES))
def silver_compacted(spark: SparkSession, d: str) -> DataFrame:
    """Three deduplicated loads, their folders put together, and one more load looked up against the result."""
    root = _scratch(spark, "compacted")
    # written once: otherwise each load puts together and parses all messages anew
    bronze = materialize(B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES, malformed=False, dups=True)), "compacted-bronze")
    bounds = ["", "2024-01-08", MARK, "2024-01-24", "9"]
    for i, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
        rows = SV.silver_trades(bronze.where((F.col("ingest_ts") > low) & (F.col("ingest_ts") <= high)))
        JOBS.store_load(spark, rows, "trades", f"{root}/silver", "batch", i)
        if i == 2:
            JOBS.compact_silver(spark, "trades", f"{root}/silver")
    return JOBS.read_lake(spark, f"{root}/silver", S.SILVER_TRADES).drop("ingest_ts")


# ---------------------------------------------------------------- quality

@register("dedup_trades", _silver_trades_sql(False, False))
def dedup_trades_q(spark: SparkSession, d: str) -> DataFrame:
    silver = SV.silver_trades(B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES, malformed=False, dups=True)))
    return DQ.dedup_trades(silver)


@register("dedup_ticker", _with(False, silver_ticker_sql(False, False, "'' AS client_id, seq AS sequence_num,")))
def dedup_ticker_q(spark: SparkSession, d: str) -> DataFrame:
    silver = SV.silver_ticker(B.bronze_ticker(_raw(spark, d, S.CHANNEL_TICKER, malformed=False, dups=True)),
                              keep_sequence=True)
    return DQ.dedup_ticker(silver)


@register("validate_trades", _with(False, f"""
SELECT trade_id, product_id,
       list_filter([CASE WHEN product_id IS NULL OR length(product_id) = 0 THEN 'missing_product_id' END,
                    CASE WHEN trade_id IS NULL THEN 'missing_trade_id' END,
                    CASE WHEN event_ts IS NULL THEN 'bad_event_ts' END,
                    CASE WHEN price IS NULL OR price <= 0 THEN 'bad_price' END,
                    CASE WHEN size IS NULL OR size < 0 THEN 'bad_size' END,
                    CASE WHEN side IS NULL OR side NOT IN ('BUY', 'SELL') THEN 'bad_side' END],
                   lambda x: x IS NOT NULL)::VARCHAR AS dq_reasons
FROM ({bronze_trades_sql(True, False, 'event_ts')}) b"""))
def validate_trades(spark: SparkSession, d: str) -> DataFrame:
    silver = SV.silver_trades(B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES)))
    v = DQ.validate(silver)
    text = F.concat(F.lit("["), F.array_join("dq_reasons", ", "), F.lit("]"))
    return v.select("trade_id", "product_id", text.alias("dq_reasons"))


_REASONS = """list_filter([CASE WHEN product_id IS NULL OR length(product_id) = 0 THEN 'missing_product_id' END,
                    CASE WHEN trade_id IS NULL THEN 'missing_trade_id' END,
                    CASE WHEN event_ts IS NULL THEN 'bad_event_ts' END,
                    CASE WHEN price IS NULL OR price <= 0 THEN 'bad_price' END,
                    CASE WHEN size IS NULL OR size < 0 THEN 'bad_size' END,
                    CASE WHEN side IS NULL OR side NOT IN ('BUY', 'SELL') THEN 'bad_side' END], lambda x: x IS NOT NULL)::VARCHAR"""


@register("quarantine_roundtrip", _with(False, f"""
SELECT CASE WHEN dq_reasons = '[]' THEN 'silver' ELSE 'quarantine' END AS stored_in, trade_id, product_id, price, side, dq_reasons
FROM (SELECT *, {_REASONS} AS dq_reasons FROM ({bronze_trades_sql(True, False, 'event_ts')}) b)"""))
def quarantine_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """J3 in the job: one load fills silver and quarantine; both are read back."""
    root = _scratch(spark, "quarantine")
    L.write_table(B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES)), f"{root}/bronze", S.BRONZE_PARTITIONS)
    JOBS.silver_job(spark, "trades", f"{root}/bronze", f"{root}/silver", f"{root}/state", validate=True, quarantine_path=f"{root}/bad")
    cols = ("trade_id", "product_id", "price", "side")
    good = L.read_table(spark, f"{root}/silver", S.SILVER_TRADES).select(F.lit("silver").alias("stored_in"), *cols, F.lit("[]").alias("dq_reasons"))
    text = F.concat(F.lit("["), F.array_join("dq_reasons", ", "), F.lit("]"))
    bad = spark.read.parquet(f"{root}/bad").select(F.lit("quarantine").alias("stored_in"), *cols, text.alias("dq_reasons"))
    return good.unionByName(bad)


@register("silver_job_enforced", _with(False, f"""
SELECT CASE WHEN bad THEN 'quarantine' ELSE 'silver' END AS stored_in, event_ts, product_id, sequence_num, price, best_bid,
       CASE WHEN bad THEN 'type:price' ELSE '' END AS dq_reasons
FROM ({silver_ticker_sql(True, False, "seq AS sequence_num, event_id % 97 = 0 AS bad,")}) t"""))
def silver_job_enforced(spark: SparkSession, d: str) -> DataFrame:
    """J7 in the job, beside dedup: tickers whose price is no number go to quarantine instead of into silver without one."""
    root = _scratch(spark, "enforced")
    L.write_table(B.bronze_ticker(_raw(spark, d, S.CHANNEL_TICKER)), f"{root}/bronze", S.BRONZE_PARTITIONS)
    JOBS.silver_job(spark, "ticker", f"{root}/bronze", f"{root}/silver", f"{root}/state", dedup=True, enforce=True, quarantine_path=f"{root}/bad")
    cols = ("event_ts", "product_id", "sequence_num", "price", "best_bid")
    stored = StructType([*S.SILVER_TICKER.fields, S.BRONZE_TICKER["sequence_num"]])
    good = JOBS.read_lake(spark, f"{root}/silver", stored).select(F.lit("silver").alias("stored_in"), *cols, F.lit("").alias("dq_reasons"))
    bad = spark.read.parquet(f"{root}/bad").select(F.lit("quarantine").alias("stored_in"), *cols, F.array_join("dq_reasons", ",").alias("dq_reasons"))
    return good.unionByName(bad)


@register("ingest_date_partition", _with(False, f"""
SELECT CAST(ingest_ts[1:10] AS DATE) AS ingest_date, COUNT(*) AS n_rows
FROM ({bronze_trades_sql(True, False)}) b GROUP BY 1 HAVING CAST(ingest_ts[1:10] AS DATE) IS NULL OR CAST(ingest_ts[1:10] AS DATE) >= DATE '2024-01-14'"""))
def ingest_date_partition(spark: SparkSession, d: str) -> DataFrame:
    """Bronze written by ``ingest_date`` and read back under the mark's bound, which prunes."""
    root = _scratch(spark, "ingest-date")
    L.write_table(B.bronze_trades(_raw(spark, d, S.CHANNEL_TRADES), ingest_date=True), f"{root}/bronze", ["ingest_date", *S.BRONZE_PARTITIONS])
    b = JOBS.read_bronze(spark, "trades", f"{root}/bronze", ingest_date=True)
    recent = b.where(F.col("ingest_date").isNull() | (F.col("ingest_date") >= F.date_sub(F.lit(MARK[:10]).cast("date"), 1)))
    return recent.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- J8 partition-pruned read

@register("partition_pruned_read", """
WITH t AS (SELECT CAST(date_trunc('minute', ts) AS DATE) AS event_date, ROUND(value * 100) AS price
           FROM events
           WHERE event_type <> 'view' AND user_id % 2 = 0
             AND CAST(date_trunc('minute', ts) AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14')
SELECT event_date, COUNT(*) AS trades, SUM(price) AS price_sum FROM t GROUP BY event_date""")
def partition_pruned_read(spark: SparkSession, d: str) -> DataFrame:
    """Silver written partitioned by (event_date, product_id); the read filters on both
    partition columns, so only 7 date x 1 product folders are listed and scanned."""
    root = _scratch(spark, "pruned")
    L.write_table(TD.trades(_events(spark, d)), f"{root}/silver", S.SILVER_PARTITIONS, mode="overwrite")
    silver = L.read_table(spark, f"{root}/silver", S.SILVER_TRADES)
    part = silver.filter((F.col("product_id") == "BTC-USD")
                         & F.col("event_date").between(F.lit("2024-01-08").cast("date"),
                                                       F.lit("2024-01-14").cast("date")))
    return part.groupBy("event_date").agg(F.count(F.lit(1)).alias("trades"), F.sum("price").alias("price_sum"))


@register("partition_pruned_view", """
WITH t AS (SELECT CAST(date_trunc('minute', ts) AS DATE) AS event_date, ROUND(value * 100) AS price
           FROM events
           WHERE event_type <> 'view' AND user_id % 2 = 1 AND CAST(date_trunc('minute', ts) AS DATE) >= DATE '2024-01-20')
SELECT event_date, COUNT(*) AS trades, MAX(price) AS top FROM t GROUP BY event_date""")
def partition_pruned_view(spark: SparkSession, d: str) -> DataFrame:
    """J8 as SQL text over a view of the partitioned table."""
    root = _scratch(spark, "view")
    L.write_table(TD.trades(_events(spark, d)), f"{root}/silver", S.SILVER_PARTITIONS, mode="overwrite")
    view = L.as_view(spark, f"{root}/silver", S.SILVER_TRADES, "silver_" + uuid.uuid4().hex[:8])
    return spark.sql(f"""SELECT event_date, count(*) AS trades, max(price) AS top FROM {view}
                         WHERE product_id = 'ETH-USD' AND event_date >= DATE '2024-01-20' GROUP BY event_date""")


# ---------------------------------------------------------------- whole lake, raw JSON -> gold



@register("lake_end_to_end", O.features_ctes() + f"SELECT {_gold_sql_cols()} FROM gold {_GOLD_FILTER}")
def lake_end_to_end(spark: SparkSession, d: str) -> DataFrame:
    """Raw topic files of both channels -> bronze streams (availableNow) -> incremental
    silver -> gold job (overwrite, partitioned) -> gold read back. Equals ``feature_table``."""
    root = _scratch(spark, "lake")
    for kind, channel in (("trades", S.CHANNEL_TRADES), ("ticker", S.CHANNEL_TICKER)):
        _raw(spark, d, channel, malformed=False).write.mode("overwrite").text(f"{root}/raw_{kind}")
        q = ST.start_bronze(L.text_stream(spark, f"{root}/raw_{kind}"), kind, f"{root}/bronze_{kind}",
                            f"{root}/ckpt_{kind}", available_now=True)
        ST.run_until_idle(q)
        JOBS.silver_job(spark, kind, f"{root}/bronze_{kind}", f"{root}/silver_{kind}", f"{root}/mark_{kind}")
    m = JOBS.gold_job(spark, f"{root}/silver_trades", f"{root}/silver_ticker", f"{root}/gold")
    if m["records_before_filter"] < m["records_after_filter"]:
        raise AssertionError(f"bad gold counts {m}")
    return _round_vol(spark.read.parquet(f"{root}/gold"))


def _gold_schema(trades: DataFrame, ticker: DataFrame) -> StructType:
    """The columns of gold. Planned with the plain window, which runs no job: the halo plan sorts and writes the trades."""
    return G.build_features(trades, ticker, strategy="plain").schema


@register("gold_published", O.features_ctes() + f"SELECT {_gold_sql_cols()} FROM gold {_GOLD_FILTER}")
def gold_published(spark: SparkSession, d: str) -> DataFrame:
    """Gold published twice by switching manifests, the first time from half of the trades; read back through
    the last one. Equals ``feature_table``."""
    root = _scratch(spark, "published")
    ev = _events(spark, d)
    L.write_table(TD.ticker(ev), f"{root}/ticker", S.SILVER_PARTITIONS)
    trades = TD.trades(ev)
    for part in (trades.where(F.col("event_date") < "2024-01-15"), trades.where(F.col("event_date") >= "2024-01-15")):
        L.write_table(part, f"{root}/trades", S.SILVER_PARTITIONS)
        JOBS.gold_job(spark, f"{root}/trades", f"{root}/ticker", f"{root}/gold", publish=True)
    return _round_vol(JOBS.read_lake(spark, f"{root}/gold", _gold_schema(trades, TD.ticker(ev))))


@register("gold_incremental", O.features_ctes() + f"SELECT {_gold_sql_cols()} FROM gold {_GOLD_FILTER}")
def gold_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Gold by three increments: trades of all but two days, with two days' quotes missing; a newer day; then a
    late day and the quotes. Equals ``feature_table``."""
    root = _scratch(spark, "incremental-gold")
    ev = _events(spark, d)
    late, newest = F.col("event_date") == F.lit("2024-01-12").cast("date"), F.col("event_date") >= F.lit("2024-01-20").cast("date")
    trades, ticker = TD.trades(ev), TD.ticker(ev)
    steps = ((trades.where(~late & ~newest), ticker.where(~late & ~newest)), (trades.where(newest), None), (trades.where(late), ticker.where(late | newest)))
    for step in steps:
        for kind, rows in zip(("trades", "ticker"), step, strict=True):
            if rows is not None:
                load = C.new_load()
                C.commit(spark, f"{root}/{kind}", C.appended(load, C.write_load(rows, f"{root}/{kind}", S.SILVER_PARTITIONS, load)))
        INC.gold_increment(spark, f"{root}/trades", f"{root}/ticker", f"{root}/gold")
    return _round_vol(INC.read_gold(spark, f"{root}/gold", _gold_schema(trades, ticker)))


@register("target50_filter", O.features_ctes() +
          f"SELECT product_id, trade_id, target_return_50 FROM gold {_GOLD_FILTER} AND target_return_50 IS NOT NULL")
def target50_filter(spark: SparkSession, d: str) -> DataFrame:
    return DQ.target50_filter(_gold(spark, d)).select("product_id", "trade_id", "target_return_50")
