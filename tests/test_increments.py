"""Gold by increments against a full build of the same rows."""

from __future__ import annotations

import pytest
from conftest import trade_rows
from pyspark.sql import functions as F

from marketlake import schemas as S
from marketlake.plans import features as G
from marketlake.plans import increments as INC
from marketlake.sources import commits as C


def _trades(spark, rows):
    """rows: (product, day, number within the day)."""
    df = trade_rows(spark, [(p, f"2024-01-{d:02d}T{i // 60:02d}:{i % 60:02d}:00Z", f"{i:05d}", 100.0 + (i * 7 + d) % 13, 1.0 + i % 3, "BUY" if i % 2 else "SELL")
                            for p, d, i in rows])
    return df.withColumn("event_date", F.to_date(F.substring("event_ts", 1, 10))).select(*S.SILVER_TRADES.names)


def _ticker(spark, rows):
    df = spark.createDataFrame([(p, f"2024-01-{d:02d}T{i // 60:02d}:{i % 60:02d}:30Z", b) for p, d, i, b in rows],
                               "product_id string, event_ts string, best_bid double")
    cols = {"ingest_ts": F.col("event_ts"), "best_ask": F.col("best_bid") + 1, "event_date": F.to_date(F.substring("event_ts", 1, 10))}
    df = df.withColumns(cols)
    return df.select(*(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in S.SILVER_TICKER.fields))


def _load(spark, path, rows):
    load = C.new_load()
    C.commit(spark, path, C.appended(load, C.write_load(rows, path, S.SILVER_PARTITIONS, load)))


def _same(spark, root):
    trades = C.read_committed(spark, f"{root}/trades", S.SILVER_TRADES)
    full = G.build_features(trades, C.read_committed(spark, f"{root}/ticker", S.SILVER_TICKER))
    order = lambda df: sorted(map(repr, (tuple(r) for r in df.select(*full.columns).collect())))
    got = INC.read_gold(spark, f"{root}/gold", full.schema)
    assert order(got) == order(full)
    return got


def _run(spark, root):
    return INC.gold_increment(spark, f"{root}/trades", f"{root}/ticker", f"{root}/gold")


def test_increments_equal_a_full_build(spark, tmp_path):
    root = str(tmp_path)
    days = {1: 600, 2: 20, 3: 600, 4: 600, 5: 600}
    _load(spark, f"{root}/trades", _trades(spark, [("A", d, i) for d, n in days.items() for i in range(n)] + [("B", d, i) for d in days for i in range(60)]))
    _load(spark, f"{root}/ticker", _ticker(spark, [("A", 3, 5, 99.0)]))
    assert _run(spark, root)["full"]
    _same(spark, root)
    assert _run(spark, root) == {"full": False, "dates": [], "rows": 0}

    _load(spark, f"{root}/trades", _trades(spark, [("A", 2, 700)]))  # late: the day itself, the end of day 1, day 3
    step = _run(spark, root)
    assert not step["full"] and step["dates"] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    _same(spark, root)

    _load(spark, f"{root}/ticker", _ticker(spark, [("A", 5, 8, 98.0), ("C", 4, 1, 1.0)]))  # a quote touches its own day; C has no trades
    assert _run(spark, root)["dates"] == ["2024-01-05"]
    got = _same(spark, root)
    assert {r.event_date for r in got.select("event_date").distinct().collect()} == {r.event_date for r in _trades(
        spark, [("A", d, 0) for d in days]).collect()}

    _load(spark, f"{root}/trades", _trades(spark, [("B", 6, i) for i in range(30)] + [("N", 6, 1)]))  # sparse B: all its days are near
    _run(spark, root)
    _same(spark, root)


def test_null_times_and_products_and_lost_loads(spark, tmp_path):
    root = str(tmp_path)
    rows = _trades(spark, [("A", d, i) for d in (1, 2) for i in range(30)])
    nulls = rows.limit(15).withColumns({"event_ts": F.lit(None).cast("string"), "event_date": F.lit(None).cast("date")})
    _load(spark, f"{root}/trades", rows)
    _load(spark, f"{root}/ticker", _ticker(spark, [("A", 1, 1, 99.0)]))
    _run(spark, root)
    _load(spark, f"{root}/trades", nulls.unionByName(rows.limit(20).withColumn("product_id", F.lit(None).cast("string"))))
    assert not _run(spark, root)["full"]
    _same(spark, root)
    C.compact(spark, f"{root}/trades", S.SILVER_TRADES, S.SILVER_PARTITIONS)  # gold's loads are gone: a full build
    assert _run(spark, root)["full"]
    _same(spark, root)


def test_crash_before_the_commit_leaves_gold(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    _load(spark, f"{root}/trades", _trades(spark, [("A", 1, i) for i in range(40)]))
    _load(spark, f"{root}/ticker", _ticker(spark, [("A", 1, 1, 99.0)]))
    _run(spark, root)
    before = C.read_state(spark, f"{root}/gold")
    _load(spark, f"{root}/trades", _trades(spark, [("A", 2, i) for i in range(40)]))
    with monkeypatch.context() as m:
        m.setattr(C, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            _run(spark, root)
    assert C.read_state(spark, f"{root}/gold") == before
    _run(spark, root)
    _same(spark, root)


def test_plan_reads_touched_folders_only(spark, tmp_path):
    root = str(tmp_path)
    _load(spark, f"{root}/trades", _trades(spark, [("A", d, i) for d in range(1, 6) for i in range(5)]))
    df = C.read_committed(spark, f"{root}/trades", S.SILVER_TRADES).where(INC._on_dates(["2024-01-02"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert df.count() == 5


def test_rows_outside_their_folder_are_refused(spark, tmp_path):
    root = str(tmp_path)
    _load(spark, f"{root}/trades", _trades(spark, [("A", 1, 1)]).withColumn("event_date", F.lit("2024-02-01").cast("date")))
    _load(spark, f"{root}/ticker", _ticker(spark, [("A", 1, 1, 99.0)]))
    with pytest.raises(Exception, match="outside the folder"):
        _run(spark, root)
