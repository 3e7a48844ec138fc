"""Incremental silver loads: two batches equal one full load; empty increments and rows
equal to the mark are skipped (S11, D3)."""

from __future__ import annotations

import json

from marketlake import schemas as S
from marketlake.operators import bronze as B
from marketlake.operators import incremental as I
from marketlake.operators import silver as SV
from marketlake.sources import lake as L


def _msgs(spark, items):
    values = []
    for seq, (ts, ingest, tid) in enumerate(items):
        values.append(json.dumps({
            "channel": "market_trades", "client_id": "", "timestamp": ts, "sequence_num": seq,
            "events": [{"type": "update", "trades": [{"product_id": "BTC-USD", "trade_id": tid, "price": "1",
                                                       "size": "1", "time": ts, "side": "BUY"}]}],
            "ingest_ts": ingest, "source": "ws_public"}))
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_mark_roundtrip(spark, tmp_path):
    state = str(tmp_path / "state")
    assert I.read_mark(spark, state) is None
    I.write_mark(spark, state, "2024-01-01T00:00:00.000000+00:00")
    I.write_mark(spark, state, "2024-01-02T00:00:00.000000+00:00")
    assert I.read_mark(spark, state) == "2024-01-02T00:00:00.000000+00:00"


def test_two_loads_equal_one_and_equal_mark_is_skipped(spark, tmp_path):
    bronze_path, silver, state = str(tmp_path / "b"), str(tmp_path / "s"), str(tmp_path / "m")
    first = [("2024-01-01T00:00:00Z", "2024-01-01T00:00:02.000000+00:00", "1"),
             ("2024-01-01T00:01:00Z", "2024-01-01T00:01:02.000000+00:00", "2")]
    L.write_table(B.bronze_trades(_msgs(spark, first)), bronze_path, S.BRONZE_PARTITIONS)
    r1 = I.incremental_append(spark, L.read_table(spark, bronze_path, S.BRONZE_TRADES), SV.silver_trades,
                              silver, state)
    assert r1["written"] and r1["mark"] == "2024-01-01T00:01:02.000000+00:00"

    # a late row whose ingest time equals the mark is skipped (strict >); a newer one is loaded
    second = [("2024-01-01T00:00:30Z", "2024-01-01T00:01:02.000000+00:00", "late"),
              ("2024-01-01T00:02:00Z", "2024-01-01T00:02:02.000000+00:00", "3")]
    L.write_table(B.bronze_trades(_msgs(spark, second)), bronze_path, S.BRONZE_PARTITIONS)
    r2 = I.incremental_append(spark, L.read_table(spark, bronze_path, S.BRONZE_TRADES), SV.silver_trades,
                              silver, state)
    assert r2["written"] and r2["previous_mark"] == r1["mark"] and r2["mark"] == "2024-01-01T00:02:02.000000+00:00"

    r3 = I.incremental_append(spark, L.read_table(spark, bronze_path, S.BRONZE_TRADES), SV.silver_trades,
                              silver, state)
    assert not r3["written"] and r3["mark"] == r2["mark"]
    assert I.read_mark(spark, state) == r2["mark"]

    ids = sorted(r["trade_id"] for r in L.read_table(spark, silver, S.SILVER_TRADES).collect())
    assert ids == ["1", "2", "3"]


def test_increment_filter_is_pushed_to_parquet(spark, tmp_path):
    path = str(tmp_path / "b")
    L.write_table(B.bronze_trades(_msgs(spark, [("2024-01-01T00:00:00Z", "2024-01-01T00:00:02.000000+00:00", "1")])),
                  path, S.BRONZE_PARTITIONS)
    inc = I.increment(L.read_table(spark, path, S.BRONZE_TRADES), "2024-01-01T00:00:00.000000+00:00")
    plan = inc._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(ingest_ts" in plan


def test_batch_bronze_silver_gold_jobs(spark, tmp_path):
    from conftest import SF_SMALL

    from marketlake.plans import jobs as JOBS
    from marketlake.sources import testdata as TD

    ev = TD.load_events(spark, SF_SMALL)
    root = str(tmp_path)
    for kind, channel in (("trades", "market_trades"), ("ticker", "ticker")):
        TD.raw_messages(ev, channel=channel).write.text(f"{root}/raw_{kind}")
        JOBS.bronze_batch_job(spark, f"{root}/raw_{kind}", kind, f"{root}/bronze_{kind}")
        r = JOBS.silver_job(spark, kind, f"{root}/bronze_{kind}", f"{root}/silver_{kind}", f"{root}/mark_{kind}")
        assert r["written"] and r["mark"] is not None
    m = JOBS.gold_job(spark, f"{root}/silver_trades", f"{root}/silver_ticker", f"{root}/gold")
    n_trades = TD.trades(ev).count()
    assert m["records_before_filter"] == n_trades
    assert m["records_removed"] == m["records_before_filter"] - m["records_after_filter"] >= 20  # last 10 per product
    gold = spark.read.parquet(f"{root}/gold")
    assert gold.count() == m["records_after_filter"] and len(gold.columns) == 77
