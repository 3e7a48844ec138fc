"""Committed tables, the stored-key index, and jobs on them: crashes, replays, other streams, conflicts."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F
from test_jobs_round2 import _raw, _trade

from marketlake import schemas as S
from marketlake.operators import bronze as B
from marketlake.operators import incremental as I
from marketlake.operators import keys as K
from marketlake.operators import silver as SV
from marketlake.plans import jobs as JOBS
from marketlake.sources import commits as C
from marketlake.sources import lake as L
from marketlake.streaming import jobs as ST

SCHEMA = S.StructType([S.StructField("v", S.StringType()), S.StructField("p", S.StringType())])


def _rows(spark, *values):
    return spark.createDataFrame([(v, v[0]) for v in values], SCHEMA)


def _append(spark, path, *values, **kw):
    load = C.new_load()
    return C.commit(spark, path, C.appended(load, C.write_load(_rows(spark, *values), path, ["p"], load), **kw))


def _values(spark, path):
    return sorted(r.v for r in C.read_committed(spark, path, SCHEMA).collect())


def _ids(spark, path):
    return sorted(str(r.trade_id) for r in JOBS.read_lake(spark, path, S.SILVER_TRADES).collect())


def test_loads_become_visible_by_their_manifest(spark, tmp_path):
    path = str(tmp_path / "t")
    assert _values(spark, path) == [] and not C.is_committed_table(spark, path)
    _append(spark, path, "a1", "b1")
    C.write_load(_rows(spark, "a2"), path, ["p"], C.new_load())  # a writer that crashed before its manifest
    assert _values(spark, path) == ["a1", "b1"]
    state = _append(spark, path, "a3", stream="s", batch=4, mark="m")
    assert _values(spark, path) == ["a1", "a3", "b1"] and state.number == 2 and state.marks == {"s": "m"}
    assert _append(spark, path, "a3", stream="s", batch=4).number == 2  # a replay
    assert sorted(r.v for r in C.read_committed(spark, path, SCHEMA, C.read_state(spark, path, 1)).collect()) == ["a1", "b1"]
    gone = C.vacuum(spark, path, keep=1)
    assert len(gone) == 2 and _values(spark, path) == ["a1", "a3", "b1"]  # what crashed and what the replay wrote


def test_partition_filters_prune_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    _append(spark, path, "a1", "b1")
    _append(spark, path, "a2", "c1")
    plan = C.read_committed(spark, path, SCHEMA).where("p = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "(p#" in plan[plan.index("PartitionFilters"):].split("]")[0]


def test_a_manifest_is_put_once(spark, tmp_path):
    file = str(tmp_path / "d" / "f.json")
    assert C.put_if_absent(spark, file, "one") and not C.put_if_absent(spark, file, "two")
    assert open(file).read() == "one" and [f for f in os.listdir(tmp_path / "d") if not f.endswith(".crc")] == ["f.json"]


def test_writers_do_not_lose_each_others_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    _append(spark, path, "a1")
    calls = []

    def change(s):
        if not calls:  # another writer commits between reading and writing the manifest
            calls.append(1)
            _append(spark, path, "b1")
        return C.appended("x", 0)(s)

    state = C.commit(spark, path, change)
    assert state.number == 3 and len(state.loads) == 3 and _values(spark, path) == ["a1", "b1"]
    with pytest.raises(C.Conflict):
        C.commit(spark, path, C.appended("y", 0), based_on=2)


def test_a_failed_overwrite_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    C.overwrite(_rows(spark, "a1", "b1"), path, ["p"])

    def refuse(rows):
        raise ValueError(rows)

    with pytest.raises(ValueError):
        C.overwrite(_rows(spark, "a2"), path, ["p"], check=refuse)
    bad = _rows(spark, "a2").withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        C.overwrite(bad, path, ["p"])
    assert _values(spark, path) == ["a1", "b1"]
    C.overwrite(_rows(spark, "a3"), path, ["p"])
    assert _values(spark, path) == ["a3"]


def test_compaction_keeps_the_rows_and_readers(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        _append(spark, path, f"a{i}", f"b{i}", "a0")
    before = C.read_state(spark, path)
    reader = C.read_committed(spark, path, SCHEMA, before)
    want = _values(spark, path)
    state = C.compact(spark, path, SCHEMA, ["p"])
    assert _values(spark, path) == want == sorted(r.v for r in reader.collect())
    assert len(state.loads) == 1 and len(C.read_committed(spark, path, SCHEMA).inputFiles()) == 2  # one file a partition
    assert len(reader.inputFiles()) == 8
    assert C.compact(spark, path, SCHEMA, ["p"]).number == state.number


KEYS = ("product_id", "trade_id")


def _indexed(spark, path, ids):
    rows = spark.createDataFrame([("BTC-USD" if i is not None else None, None if i is None else str(i)) for i in ids], "product_id string, trade_id string")
    load = C.new_load()
    n = C.write_load(rows.withColumn("event_date", F.lit("2024-01-01").cast("date")), path, ["event_date"], load)
    K.write_index(spark, path, load, n, rows.schema, KEYS)
    return C.commit(spark, path, C.appended(load, n))


def test_a_load_opens_only_folders_that_may_hold_its_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    for start in (0, 5000, 10000):
        state = _indexed(spark, path, [*range(start, start + 3000), None])
    sent = spark.createDataFrame([("BTC-USD", str(i)) for i in (5001, 20000, 20001)] + [(None, "7"), ("ETH-USD", "5")], "product_id string, trade_id string")
    folders = K.folders_to_open(K._keyed(sent, KEYS), path, state)
    assert 1 <= len(folders) <= 3  # of 192: the stored key's own one, and hardly another
    left = K.not_stored(sent, path, state, KEYS)
    assert sorted(str(r.trade_id) for r in left.collect()) == ["20000", "20001", "5", "7"]
    stored = [f for f in left.inputFiles() if "/_keys/" in f]
    assert {tuple(f.split("/_keys/load_id=")[1].split("/bucket=")) for f in stored} <= {(a, f"{b}/" + f.rsplit("/", 1)[1]) for a, b in folders for f in stored}
    assert K.not_stored(sent.where("trade_id > '2' AND trade_id < '3'"), path, state, KEYS).count() == 2


def test_the_index_forgets_no_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "BROADCAST_BYTES", 0)
    path, rng = str(tmp_path / "t"), random.Random(1)
    stored = set()
    for _ in range(3):
        ids = rng.sample(range(4000), 300)
        state = _indexed(spark, path, ids)
        stored |= set(ids)
    sent = spark.createDataFrame([("BTC-USD", str(i)) for i in range(4000)], "product_id string, trade_id string")
    assert {int(r.trade_id) for r in K.not_stored(sent, path, state, KEYS).collect()} == set(range(4000)) - stored
    assert K.folders_to_open(K._keyed(sent, KEYS), path, C.State()) == []


def test_a_stream_with_a_new_checkpoint_adds_to_what_is_stored(spark, tmp_path):
    silver = str(tmp_path / "s")
    for part, days in (("one", (1, 2, 3)), ("two", (3, 4))):
        L.write_table(B.bronze_trades(_raw(spark, [_trade(d, str(d)) for d in days])), str(tmp_path / part), S.BRONZE_PARTITIONS)
        ST.run_until_idle(ST.start_silver(spark, str(tmp_path / part), "trades", silver, str(tmp_path / f"ckpt-{part}"), dedup=True))
    assert _ids(spark, silver) == ["1", "2", "3", "4"]
    # the first checkpoint is lost: its bronze comes again under another stream
    ST.run_until_idle(ST.start_silver(spark, str(tmp_path / "one"), "trades", silver, str(tmp_path / "ckpt-new"), dedup=True))
    assert _ids(spark, silver) == ["1", "2", "3", "4"]


def test_a_replay_with_an_earlier_copy_on_another_date_adds_nothing(spark, tmp_path):
    silver = str(tmp_path / "s")
    first, second = (SV.silver_trades(B.bronze_trades(_raw(spark, [_trade(d, "1")]))) for d in (5, 4))
    for rows in (first, second):
        JOBS.store_load(spark, rows, "trades", silver, "stream", 0)
    assert _ids(spark, silver) == ["1"]


def test_a_crash_before_the_manifest_leaves_rows_and_mark(spark, tmp_path, monkeypatch):
    bronze, silver, state = (str(tmp_path / n) for n in ("b", "s", "m"))
    L.write_table(B.bronze_trades(_raw(spark, [_trade(1, "1")])), bronze, S.BRONZE_PARTITIONS)
    run = lambda: JOBS.silver_job(spark, "trades", bronze, silver, state, dedup=True)
    run()
    L.write_table(B.bronze_trades(_raw(spark, [_trade(2, "2")])), bronze, S.BRONZE_PARTITIONS)
    before = C.read_state(spark, silver)

    def crash(*_, **__):
        raise RuntimeError("crash")

    monkeypatch.setattr(C, "commit", crash)
    with pytest.raises(RuntimeError):
        run()
    assert C.read_state(spark, silver) == before and _ids(spark, silver) == ["1"]
    monkeypatch.undo()
    assert run()["mark"] > before.marks[JOBS.JOB_STREAM]
    assert _ids(spark, silver) == ["1", "2"] and not run()["written"]


@pytest.mark.parametrize("dedup", [False, True])
def test_a_load_without_items_moves_the_mark(spark, tmp_path, dedup):
    """Ticker messages that hold no ticker yield no silver row, but they are done with."""
    rows = spark.createDataFrame([('{"channel": "ticker", "timestamp": "2024-01-01T00:00:00Z", "sequence_num": %d, "ingest_ts": "2024-01-01T00:00:0%d", '
                                   '"source": "x", "events": [{"type": "update", "tickers": []}]}' % (i, i),) for i in range(5)], "value string")
    bronze = str(tmp_path / "b")
    L.write_table(B.bronze_ticker(rows), bronze, S.BRONZE_PARTITIONS)
    run = lambda: JOBS.silver_job(spark, "ticker", bronze, str(tmp_path / "s"), str(tmp_path / "m"), dedup=dedup)
    assert run() == {"written": True, "previous_mark": None, "mark": "2024-01-01T00:00:04", "bronze_rows": 5}
    assert run() == {"written": False, "previous_mark": "2024-01-01T00:00:04", "mark": "2024-01-01T00:00:04", "bronze_rows": 0}


def test_published_gold_is_audited_and_switched(spark, tmp_path, monkeypatch):
    from marketlake.plans.queries import QUERIES  # noqa: F401  (registers)

    trades, ticker, gold = (str(tmp_path / n) for n in ("t", "k", "g"))
    items = [(f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}Z", f"2024-01-01T01:00:00.{i:06d}+00:00", f"{i:04d}", str(1 + i % 7)) for i in range(40)]
    L.write_table(SV.silver_trades(B.bronze_trades(_raw(spark, items))), trades, S.SILVER_PARTITIONS)
    L.write_table(spark.createDataFrame([], S.SILVER_TICKER), ticker, S.SILVER_PARTITIONS)
    m = JOBS.gold_job(spark, trades, ticker, gold, publish=True)
    state = C.read_state(spark, gold)
    assert sum(state.loads.values()) == m["records_after_filter"] == 30 and m["input_trades"] == 40

    def crash(*_, **__):
        raise RuntimeError("crash")

    monkeypatch.setattr(C, "commit", crash)
    with pytest.raises(RuntimeError):
        JOBS.gold_job(spark, trades, ticker, gold, publish=True)
    monkeypatch.undo()
    assert C.read_state(spark, gold) == state


def test_watched_increment_without_observation(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "ingest_ts string, v int")
    watched = I.Watched(rows, "a")
    watched.rows.where("v > 5").write.format("noop").mode("overwrite").save()
    assert watched.report() == {"written": True, "previous_mark": "a", "mark": "b", "bronze_rows": 1}
