"""Loads that crash or repeat, late rows, quarantine, limits, scopes and even tasks."""

from __future__ import annotations

import glob
import json
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from marketlake import schemas as S
from marketlake import session as SE
from marketlake.operators import bronze as B
from marketlake.operators import incremental as I
from marketlake.operators import routing as R
from marketlake.operators import silver as SV
from marketlake.operators import windows as W
from marketlake.plans import jobs as JOBS
from marketlake.sources import lake as L
from marketlake.streaming import jobs as ST


def _raw(spark, items):
    """Messages of one trade each: (envelope time, ingest time, trade id, price)."""
    rows = [(json.dumps({"channel": "market_trades", "timestamp": t, "sequence_num": n, "ingest_ts": i, "source": "ws_public", "events": [
        {"type": "update", "trades": [{"product_id": "BTC-USD", "trade_id": tid, "price": p, "size": "1", "time": t, "side": "BUY"}]}]}),)
        for n, (t, i, tid, p) in enumerate(items)]
    return spark.createDataFrame(rows, "value string")


def _trade(day: int, tid: str | None, price: str = "1") -> tuple:
    return f"2024-01-{day:02d}T00:00:00Z", f"2024-01-{day:02d}T00:00:02.000000+00:00", tid, price


def _ids(spark, path):
    return sorted(str(r.trade_id) for r in spark.read.parquet(path).collect())


def test_unconfigured_session_has_no_shared_folder():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(conf={}, sparkContext=context)
    for folder in (SE.shared_folder, SE.use_local_folder):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            folder(session)
    session.conf["spark.checkpoint.dir"] = "hdfs://shared/"
    assert SE.use_local_folder(session) == "hdfs://shared"


def test_scopes_delete_their_own_tables_only(spark):
    with SE.scratch_scope(spark) as outer:
        a = SE.materialize(spark.range(5), "a")
        with SE.scratch_scope(spark) as inner:
            SE.materialize(spark.range(6), "b")
        assert len(outer) == len(inner) == 1 and not L.path_exists(spark, inner[0])
        assert a.count() == 5
    assert not L.path_exists(spark, outer[0])
    with pytest.raises(RuntimeError), SE.scratch_scope(spark) as failed:
        SE.materialize(spark.range(1), "c")
        raise RuntimeError
    assert not L.path_exists(spark, failed[0])


def test_mark_survives_a_crash_between_write_and_clean_up(spark, tmp_path, monkeypatch):
    state = str(tmp_path / "state")
    I.write_mark(spark, state, "a")

    def crash(*_):
        raise RuntimeError("crash")

    monkeypatch.setattr(I, "delete_path", crash)
    with pytest.raises(RuntimeError):
        I.write_mark(spark, state, "b")
    assert I.read_mark(spark, state) == "b"
    monkeypatch.undo()
    I.write_mark(spark, state, "c")
    assert I.read_mark(spark, state) == "c" and len(L.data_files(spark, state)) == 1
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="no mark"):
        I.read_mark(spark, str(tmp_path / "empty"))
    I.write_mark(spark, str(tmp_path / "blank"), "")
    assert I.read_mark(spark, str(tmp_path / "blank")) is None


def test_increment_prunes_ingest_dates(spark, tmp_path):
    path = str(tmp_path / "b")
    rows = B.bronze_trades(_raw(spark, [_trade(d, str(d)) for d in (1, 2, 10, 11)] + [("bad", None, "n", "1")]), ingest_date=True)
    L.write_table(rows, path, ["ingest_date", *S.BRONZE_PARTITIONS])
    inc = I.increment(JOBS.read_bronze(spark, "trades", path, ingest_date=True), _trade(10, "")[1])
    assert [r.trade_id for r in inc.collect()] == ["11"]
    plan = inc._jdf.queryExecution().executedPlan().toString()
    assert "ingest_date" in plan[plan.index("PartitionFilters"):].split("]")[0]


def test_silver_job_keeps_late_rows_and_drops_stored_ones(spark, tmp_path):
    bronze, silver, state = (str(tmp_path / n) for n in ("b", "s", "m"))

    def load(items, mark_to=None):
        L.write_table(B.bronze_trades(_raw(spark, items)), bronze, S.BRONZE_PARTITIONS)
        return JOBS.silver_job(spark, "trades", bronze, silver, state, dedup=True)

    load([_trade(5, "1"), _trade(5, "1"), _trade(5, None)])
    load([("2024-01-01T00:00:00Z", *_trade(6, "2")[1:]), ("2024-01-05T00:00:00Z", *_trade(6, "1")[1:])])  # late row, re-sent row
    assert _ids(spark, silver) == ["1", "2", "None"]
    # the same batch twice changes nothing
    rows = SV.silver_trades(L.read_table(spark, bronze, S.BRONZE_TRADES))
    for _ in range(2):
        JOBS.store_load(spark, rows, "trades", str(tmp_path / "again"), "x", 0)
    assert _ids(spark, str(tmp_path / "again")) == ["1", "2", "None"]
    assert not JOBS.silver_job(spark, "trades", bronze, silver, state, dedup=True)["written"]
    assert _ids(spark, silver) == ["1", "2", "None"]


@pytest.mark.parametrize("kind", ["trades"])
def test_stream_in_several_batches_equals_batch_and_replays(spark, tmp_path, kind):
    bronze, silver = str(tmp_path / "b"), str(tmp_path / "s")
    for day in (9, 3, 7):  # one file each; the second is ingested days before the first
        L.write_table(B.bronze_trades(_raw(spark, [_trade(day, str(day)), _trade(day, "9")])).coalesce(1), bronze, S.BRONZE_PARTITIONS)
    q = ST.start_silver(spark, bronze, kind, silver, str(tmp_path / "c"), dedup=True, max_files=1)
    assert ST.run_until_idle(q)
    assert len(q.recentProgress) >= 3
    assert _ids(spark, silver) == ["3", "7", "9"]
    stream = ST.stream_name(spark, str(tmp_path / "c"))
    JOBS.store_load(spark, SE.materialize(JOBS.read_lake(spark, silver, S.SILVER_TRADES), "replay"), kind, silver, stream, 1)
    assert _ids(spark, silver) == ["3", "7", "9"]


def test_a_running_query_is_left_running(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    q = ST.start_bronze(L.text_stream(spark, str(tmp_path / "raw")), "trades", str(tmp_path / "b"), str(tmp_path / "c"), processing_time="1 second")
    try:
        assert not ST.run_until_idle(q, timeout_s=1) and q.isActive
    finally:
        q.stop()


def test_quarantine(spark, tmp_path):
    bronze, silver, state, bad = (str(tmp_path / n) for n in ("b", "s", "m", "q"))
    L.write_table(B.bronze_trades(_raw(spark, [_trade(1, "1"), _trade(1, "2", "nope"), _trade(1, None)])), bronze, S.BRONZE_PARTITIONS)
    JOBS.silver_job(spark, "trades", bronze, silver, state, validate=True, quarantine_path=bad)
    assert _ids(spark, silver) == ["1"]
    assert {(r.trade_id, tuple(r.dq_reasons)) for r in spark.read.parquet(bad).collect()} == {("2", ("bad_price",)), (None, ("missing_trade_id",))}
    with pytest.raises(ValueError, match="quarantine_path"):
        JOBS.silver_job(spark, "trades", bronze, silver, state, validate=True)


def test_enforced_schema_in_the_job(spark, tmp_path):
    """Lost numbers go to quarantine with their columns, with and without dedup; NULL and absent numbers are no loss."""
    item = '{"type": "update", "tickers": [{"product_id": "BTC-USD", "price": %s, "best_bid": %s, "best_ask": null}]}'
    text = '{"channel": "ticker", "client_id": "", "timestamp": "2024-01-01T00:00:0%dZ", "ingest_ts": "2024-01-01T00:00:0%d", "sequence_num": %d, "events": [%s]}'
    prices = [('"1.5"', '"1"'), ('"bad"', '"x"'), ("null", '"2"'), ('"3"', '"-"')]
    rows = [(text % (i, i, i, item % p),) for i, p in enumerate(prices)]
    bronze = str(tmp_path / "b")
    L.write_table(B.bronze_ticker(spark.createDataFrame(rows, "value string")), bronze, S.BRONZE_PARTITIONS)
    for dedup in (False, True):
        silver, state, bad = (str(tmp_path / f"{n}{dedup}") for n in "smq")
        assert JOBS.silver_job(spark, "ticker", bronze, silver, state, dedup=dedup, enforce=True, quarantine_path=bad)["bronze_rows"] == 4
        stored = JOBS.read_lake(spark, silver, S.SILVER_TICKER)
        assert sorted((r.event_ts[-3:], r.price, r.best_bid) for r in stored.collect()) == [("00Z", 1.5, 1.0), ("02Z", None, 2.0)]
        assert {(r.event_ts[-3:], tuple(r.dq_reasons)) for r in spark.read.parquet(bad).collect()} == {
            ("01Z", ("type:price", "type:best_bid")), ("03Z", ("type:best_bid",))}
    with pytest.raises(ValueError, match="quarantine_path"):
        JOBS.silver_job(spark, "ticker", bronze, silver, state, enforce=True)


def test_schema_report(spark):
    df = spark.createDataFrame([("x", "1.5"), ("y", "bad"), ("z", None)], "product_id string, price string")
    schema = SV.StructType([S.SILVER_TRADES["product_id"], S.SILVER_TRADES["price"]])
    assert [(r.price, r.lost) for r in SV.enforce_schema(df, schema, report="lost").collect()] == [(1.5, []), (None, ["price"]), (None, [])]


def test_topic_sink_needs_a_checkpoint(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    routed = R.route_messages(L.text_stream(spark, str(tmp_path / "raw")))
    with pytest.raises(ValueError, match="checkpoint"):
        L.write_topic(routed, "broker:9092")


def test_codec_in_the_footer(spark, tmp_path):
    import pyarrow.parquet as pq

    L.write_table(spark.range(10).withColumn("p", F.lit(1)), str(tmp_path / "t"), ["p"])
    meta = pq.ParquetFile(glob.glob(f"{tmp_path}/t/p=1/*.parquet")[0]).metadata
    assert meta.row_group(0).column(0).compression == "SNAPPY"


def test_equal_rows_do_not_share_one_range_partition(spark):
    rows = [("BTC-USD", f"2024-01-01 00:00:{i % 60:02d}", str(i)) for i in range(2000)] + [(None, None, None)] * 2000
    df = spark.createDataFrame(rows, "product_id string, event_ts_dt string, trade_id string")
    with SE.scratch_scope(spark) as tables:
        idx = W.row_index(df, ["product_id"], ["event_ts_dt", "trade_id"], 8)
        sizes = Counter(r.f for r in spark.read.parquet(*tables).select(F.input_file_name().alias("f")).collect())
        assert len(sizes) == 8 and max(sizes.values()) <= 1.8 * 4000 / 8
        assert sorted(r._r for r in idx.where("product_id IS NULL").collect()) == list(range(2000))


def test_time_features_move_nothing(spark):
    from conftest import SF_SMALL

    from marketlake.plans.queries import QUERIES

    plan = QUERIES["time_features"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "marketlake-scratch" not in plan
