"""Hand-written edge rows (FIXTURES.md §5): one test per semantic corner."""

from __future__ import annotations

import json

import pytest
from conftest import ticker_rows, trade_rows

from marketlake import schemas as S
from marketlake.operators import bronze as B
from marketlake.operators import routing as R
from marketlake.operators import silver as SV
from marketlake.plans import features as G

STRATEGIES = [("plain", {}), ("halo", {"chunk_rows": 500})]


def _msg(**kw) -> str:
    base = {"channel": "market_trades", "client_id": "", "timestamp": "2024-01-01T00:10:00Z", "sequence_num": 7,
            "events": [{"type": "update", "trades": [{"product_id": "BTC-USD", "trade_id": "1", "price": "10",
                                                      "size": "2", "time": "2024-01-01T00:09:58.5Z", "side": "BUY"}]}],
            "ingest_ts": "2024-01-01T00:10:02.000000+00:00", "source": "ws_public"}
    base.update(kw)
    return json.dumps(base)


def _raw(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_garbage_value_keeps_bronze_trade_row_but_silver_ticker_drops_it(spark):
    raw = _raw(spark, ["garbage", "", None])
    trades = B.bronze_trades(raw).collect()
    assert len(trades) == 3
    assert all(r["product_id"] is None and r["price"] is None and r["event_date"] is None for r in trades)
    ticker = B.bronze_ticker(raw)
    assert ticker.count() == 3
    assert SV.silver_ticker(ticker).count() == 0


def test_wrong_typed_field_is_null_alone(spark):
    msg = _msg(sequence_num="not-a-number")
    row = B.bronze_trades(_raw(spark, [msg])).collect()[0]
    assert row["channel"] == "market_trades" and row["price"] == 10.0 and row["product_id"] == "BTC-USD"
    t = B.bronze_ticker(_raw(spark, [msg.replace("market_trades", "ticker")])).collect()[0]
    assert t["sequence_num"] is None and t["channel"] == "ticker"


def test_bad_number_text_becomes_null(spark):
    msg = _msg(events=[{"type": "update", "trades": [{"product_id": "BTC-USD", "trade_id": "1", "price": "bad",
                                                       "size": "3", "side": "SELL"}]}])
    row = B.bronze_trades(_raw(spark, [msg])).collect()[0]
    assert row["price"] is None and row["size"] == 3.0


def test_routing_first_event_rules(spark):
    msgs = [
        _msg(channel="ticker", events=[{"type": "snapshot", "tickers": [{}], "trades": [{"product_id": "B"}]}]),
        _msg(events=[{"type": "update", "trades": [{"product_id": ""}]}]),
        _msg(channel="heartbeats"),
        _msg(events=[]),
        "[1, 2, 3]",
        "not json",
        _msg(channel="ticker", events=[{"type": "update", "tickers": [{"product_id": "ETH-USD"}]}]),
        _msg(),
    ]
    out = R.route_messages(_raw(spark, msgs), ingest_ts="2024-02-01T00:00:00.000000+00:00").collect()
    got = sorted((r["topic"], r["key"]) for r in out)
    assert got == [("crypto.ticker.raw", "ETH-USD"), ("crypto.trades.raw", "BTC-USD")]
    v = json.loads([r for r in out if r["key"] == "BTC-USD"][0]["value"])
    assert v["ingest_ts"] == "2024-02-01T00:00:00.000000+00:00" and v["source"] == "ws_public"
    assert v["events"][0]["trades"][0]["trade_id"] == "1"


def test_routing_stamps_current_time_in_utc_iso(spark):
    out = R.route_messages(_raw(spark, [_msg()])).collect()[0]
    ts = json.loads(out["value"])["ingest_ts"]
    assert len(ts) == len("2024-01-01T00:10:02.000000+00:00") and ts.endswith("+00:00") and ts[10] == "T"


def test_product_filter(spark):
    out = R.route_messages(_raw(spark, [_msg()]), ingest_ts="x", products=["ETH-USD"])
    assert out.count() == 0


@pytest.mark.parametrize("strategy,kw", STRATEGIES)
def test_single_trade_product(spark, strategy, kw):
    t = trade_rows(spark, [("SOL-USD", "2024-01-01T00:00:00Z", "1", 100.0, 1.0, "BUY")])
    f = G.build_features(t, ticker_rows(spark, []), strategy=strategy, apply_filter=False, **kw).collect()[0]
    assert f["volatility_10"] is None and f["price_change_1"] is None
    assert f["return_1"] == 0.0 and f["return_100"] == 0.0
    assert f["future_price_10"] is None and f["target_return_10"] is None and f["target_direction_10"] is None
    assert f["ma_500_trades"] == 100.0 and f["buy_sell_ratio_50"] == 0.0


@pytest.mark.parametrize("strategy,kw", STRATEGIES)
def test_trade_id_is_ordered_as_text(spark, strategy, kw):
    t = trade_rows(spark, [("BTC-USD", "2024-01-01T00:00:00Z", "999", 10.0, 1.0, "BUY"),
                           ("BTC-USD", "2024-01-01T00:00:00Z", "1000", 20.0, 1.0, "BUY")])
    f = {r["trade_id"]: r for r in G.build_features(t, ticker_rows(spark, []), strategy=strategy,
                                                    apply_filter=False, **kw).collect()}
    assert f["1000"]["price_change_1"] is None  # "1000" < "999": first row
    assert f["999"]["price_change_1"] == -10.0


@pytest.mark.parametrize("strategy,kw", STRATEGIES)
def test_zero_lag_price_gives_null_return(spark, strategy, kw):
    t = trade_rows(spark, [("BTC-USD", "2024-01-01T00:00:00Z", "1", 0.0, 1.0, "BUY"),
                           ("BTC-USD", "2024-01-01T00:01:00Z", "2", 5.0, 1.0, "SELL")])
    f = {r["trade_id"]: r for r in G.build_features(t, ticker_rows(spark, []), strategy=strategy,
                                                    apply_filter=False, **kw).collect()}
    assert f["1"]["return_1"] == 0.0  # no lag -> 0
    assert f["2"]["return_1"] is None  # lag price 0 -> NULL, not an error
    assert f["1"]["target_return_10"] is None
    assert f["1"]["price_vs_ma_10"] == 0.0  # ma 0 is not > 0


def test_bid_without_ask_and_minutes_without_ticker(spark):
    t = trade_rows(spark, [("BTC-USD", "2024-01-01T00:00:10Z", "1", 100.0, 1.0, "BUY"),
                           ("BTC-USD", "2024-01-01T00:05:10Z", "2", 100.0, 1.0, "BUY")])
    q = ticker_rows(spark, [("BTC-USD", "2024-01-01T00:00:30Z", "i1", 95.0, None),
                            ("BTC-USD", "2024-01-01T00:00:20Z", "i0", 90.0, 110.0)])
    f = {r["trade_id"]: r for r in G.build_features(t, q, apply_filter=False).collect()}
    a = f["1"]  # last ticker of the minute (00:00:30, after the trade) has no ask
    assert a["best_bid"] == 95.0 and a["best_ask"] is None
    assert a["bid_ask_spread"] == 0.0 and a["spread_pct"] is None and a["price_vs_ask"] == 0.0
    assert a["price_vs_bid"] == pytest.approx((100 - 95) / 95 * 100)
    b = f["2"]
    assert (b["bid_ask_spread"], b["spread_pct"], b["price_vs_bid"], b["price_vs_ask"]) == (0.0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("strategy,kw", STRATEGIES)
def test_future_equal_price_direction_null_and_final_filter(spark, strategy, kw):
    rows = [("BTC-USD", f"2024-01-01T00:{i:02d}:00Z", f"{i:02d}", 7.0, 1.0, "BUY") for i in range(12)]
    t = trade_rows(spark, rows)
    full = G.build_features(t, ticker_rows(spark, []), strategy=strategy, apply_filter=False, **kw)
    first = full.filter("trade_id = '00'").collect()[0]
    assert first["target_return_10"] == 0.0 and first["target_direction_10"] is None
    kept = G.build_features(t, ticker_rows(spark, []), strategy=strategy, **kw)
    assert sorted(r["trade_id"] for r in kept.collect()) == ["00", "01"]


@pytest.mark.parametrize("strategy,kw", STRATEGIES)
def test_null_side_counts_nowhere(spark, strategy, kw):
    t = trade_rows(spark, [("BTC-USD", "2024-01-01T00:00:00Z", "1", 1.0, 4.0, None),
                           ("BTC-USD", "2024-01-01T00:00:01Z", "2", 1.0, 2.0, "SELL")])
    f = {r["trade_id"]: r for r in G.build_features(t, ticker_rows(spark, []), strategy=strategy,
                                                    apply_filter=False, **kw).collect()}
    assert f["1"]["is_buy"] == 0 and f["1"]["buy_count_50"] == 0 and f["1"]["sell_count_50"] == 0
    assert f["2"]["sell_count_50"] == 1 and f["2"]["buy_volume_ratio_50"] == 0.0
    assert f["2"]["volume_50"] == 6.0 and f["2"]["sell_volume_50"] == 2.0


def test_unparsable_event_time_is_null_and_sorted_first(spark):
    t = trade_rows(spark, [("BTC-USD", "bad time", "1", 1.0, 1.0, "BUY"),
                           ("BTC-USD", "2024-01-01T00:00:00Z", "2", 3.0, 1.0, "BUY")])
    for strategy in ("plain", "halo"):
        f = {r["trade_id"]: r for r in G.build_features(t, ticker_rows(spark, []), strategy=strategy,
                                                        apply_filter=False).collect()}
        assert f["1"]["event_ts_dt"] is None and f["1"]["hour_of_day"] is None
        assert f["2"]["price_change_1"] == 2.0


def test_time_parsing_honours_offsets_and_is_zone_independent(spark):
    from marketlake.functions import utc_time
    df = spark.createDataFrame([("2024-01-01T01:30:00Z",), ("2024-01-01T03:30:00+02:00",),
                                ("2024-01-01T01:30:00.123456789Z",), ("2024-11-03T06:30:00Z",),
                                ("2024-03-10T07:30:00Z",)], "s string")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [str(r[0]) for r in df.select(utc_time("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    # the last two fall into New York's daylight-saving overlap and gap
    assert got == ["2024-01-01 01:30:00", "2024-01-01 01:30:00", "2024-01-01 01:30:00.123456",
                   "2024-11-03 06:30:00", "2024-03-10 07:30:00"]


def test_bucket_time_is_zone_independent(spark):
    from marketlake.functions import bucket_time
    df = spark.createDataFrame([("2024-03-10 02:30:45.5",)], "s string").selectExpr("CAST(s AS TIMESTAMP_NTZ) AS t")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there
        r = df.select(*[bucket_time(u, "t").alias(u) for u in ("second", "minute", "hour", "day")]).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert [str(x) for x in r] == ["2024-03-10 02:30:45", "2024-03-10 02:30:00", "2024-03-10 02:00:00",
                                   "2024-03-10 00:00:00"]


def test_enforce_schema(spark):
    from marketlake import schemas as S
    df = spark.createDataFrame([("1",)], "trade_id string")
    with pytest.raises(ValueError):
        SV.enforce_schema(df, S.SILVER_TRADES)


def test_validate_reasons(spark):
    from marketlake.operators import quality as DQ
    t = trade_rows(spark, [("BTC-USD", "2024-01-01T00:00:00Z", "1", 1.0, 1.0, "BUY"),
                           ("", "nope", None, -1.0, None, "HOLD")])
    good, bad = DQ.split_valid(t)
    assert good.count() == 1
    r = bad.collect()[0]
    assert set(r["dq_reasons"]) == {"missing_product_id", "missing_trade_id", "bad_event_ts", "bad_price",
                                    "bad_size", "bad_side"}


def test_dedup_keeps_first_and_passes_null_keys(spark):
    from marketlake.operators import quality as DQ
    df = spark.createDataFrame(
        [("B", "1", "2024-01-01T00:00:02", 1.0), ("B", "1", "2024-01-01T01:00:02", 1.0),
         ("B", None, "x", 1.0), ("B", None, "x", 1.0)],
        "product_id string, trade_id string, ingest_ts string, price double")
    out = sorted(DQ.dedup_trades(df).collect(), key=lambda r: (r["trade_id"] is None, r["ingest_ts"]))
    assert len(out) == 3 and out[0]["ingest_ts"] == "2024-01-01T00:00:02"


def test_feature_metrics(spark):
    t = trade_rows(spark, [("BTC-USD", f"2024-01-01T00:{i:02d}:00Z", f"{i:02d}", 7.0, 1.0, "BUY") for i in range(12)])
    q = ticker_rows(spark, [("BTC-USD", "2024-01-01T00:00:30Z", "i1", 95.0, None)])
    m = {r["metric"]: r["value"] for r in
         G.feature_metrics(t, q, G.build_features(t, q, apply_filter=False)).collect()}
    assert m == {"input_trades": 12, "input_ticker": 1, "records_before_filter": 12, "records_after_filter": 2,
                 "records_removed": 10}


def test_column_count_is_77(spark):
    t = trade_rows(spark, [("BTC-USD", "2024-01-01T00:00:00Z", "1", 1.0, 1.0, "BUY")])
    assert len(G.build_features(t, ticker_rows(spark, [])).columns) == 77


def test_ticker_last_pick_is_deterministic_on_ties(spark):
    from marketlake.operators import quotes as Q
    q = G.parse_times(ticker_rows(spark, [("B", "2024-01-01T00:00:30Z", "a", 1.0, 3.0),
                                          ("B", "2024-01-01T00:00:30Z", "b", 2.0, 4.0),
                                          ("B", "2024-01-01T00:00:10Z", "z", 9.0, 9.0)]))
    r = Q.last_per_bucket(q).collect()[0]
    assert (r["best_bid"], r["best_ask"]) == (2.0, 4.0)


@pytest.mark.parametrize("quote_join", ["auto", "window"])
def test_empty_trades(spark, quote_join):
    t = trade_rows(spark, [])
    q = ticker_rows(spark, [("BTC-USD", "2024-01-01T00:00:30Z", "i1", 95.0, 96.0)])
    out = G.build_features(t, q, quote_join=quote_join)
    assert out.count() == 0 and len(out.columns) == 77


def test_messages_are_sent_as_they_came(spark):
    big, stamps = "123456789012345678901234567890123456789012345", {"ingest_ts": "now", "source": S.SOURCE_TAG}
    head = '{"channel": "ticker", "events": [{"tickers": [{"product_id": "BTC-USD"}]}]'
    msgs = [f'{head}, "n": {big}, "f": 1.0, "z": null, "s": "1", "q": "a\\"}}b"}} ', f'{head}, "x": 1, "x": "2", "n": {big}, "y": [1, "1"], "t": true}}',
            f'{head}, "source": "other", "ingest_ts": null, "x": {{"a": 1, "a": 2}}, "s": "word"}}']
    out = [r["value"] for r in R.route_messages(_raw(spark, msgs), ingest_ts="now").collect()]
    assert sorted(map(json.dumps, map(json.loads, out))) == sorted(json.dumps(json.loads(m) | stamps) if "other" not in m else
                                                                  json.dumps({k: v for k, v in json.loads(m).items() if k not in stamps} | stamps) for m in msgs)
    assert all(big in v for v in out if '"n"' in v)
    assert all(len(json.loads(v, object_pairs_hook=lambda p: p)) == len(json.loads(v)) for v in out)
