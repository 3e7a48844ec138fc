"""The long frames put together from short ones (F5, F2, F1) and steps that do their work once."""

from __future__ import annotations

import math

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as E
from marketlake.operators import routing as R
from marketlake.operators import windows as W
from marketlake.plans import features as G
from marketlake.plans import lake_queries as LQ

_SCHEMA = "product_id string, _chunk long, _r long, price double, size double, side string"


def _rows(n: int) -> list[tuple]:
    def price(i):
        if i % 700 == 350:
            return math.inf
        if i % 900 == 10:
            return math.nan
        return None if i % 7 == 3 or 200 <= i < 320 else 60000.1 + (i * 37 % 101) / 7

    return [(p, 0, i, price(i + s), None if i % 11 == 5 or 400 <= i < 520 else (i * 13 % 17) / 3, ("BUY", "SELL", None)[(i + s) % 3])
            for p, s in (("A", 0), ("B", 1000), (None, 37)) for i in range(n)]


def _same(a, b) -> bool:
    if a is None or b is None:
        return a is None and b is None
    return (math.isnan(a) and math.isnan(b)) or a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-7)


@pytest.mark.parametrize("n", [1, 9, 60, 1300])
def test_stepped_frames_equal_whole_frames(spark, n):
    df = spark.createDataFrame(_rows(n), _SCHEMA).repartition(3)
    w = W.halo_window(("product_id",))
    names = [name for name, _ in W.window_columns(w)]
    whole = W.with_columns(df, W.window_columns(w))
    stepped = W.stepped_windows(df, w)
    assert sorted(stepped.columns) == sorted(whole.columns)
    assert {f.name: f.dataType for f in stepped.schema} == {f.name: f.dataType for f in whole.schema}
    key = F.struct("product_id", "_r")
    got = {tuple(r[0]): r for r in stepped.select(key, *names).collect()}
    want = {tuple(r[0]): r for r in whole.select(key, *names).collect()}
    assert got.keys() == want.keys()
    bad = [(k, c, want[k][c], got[k][c]) for k in want for c in names if not _same(want[k][c], got[k][c])]
    assert not bad, bad[:5]


def test_halo_aggregates_short_frames_only(spark):
    trades = spark.createDataFrame([("A", "2024-01-01T00:00:00Z", "1", 1.0, 1.0, "BUY")], "product_id string, event_ts string, trade_id string, price double, size double, side string")
    plan = G.trade_features(G.parse_times(trades))._jdf.queryExecution().optimizedPlan().toString()
    assert "RowFrame, -9," in plan
    assert not [n for n in (49, 99, 499) if f"RowFrame, -{n}," in plan]


def _count_calls(monkeypatch, module, name):
    calls, real = [], getattr(module, name)

    def counted(*args, **kw):
        calls.append(args)
        return real(*args, **kw)

    monkeypatch.setattr(module, name, counted)
    return calls


def test_gold_published_numbers_the_trades_once_a_publication(spark, monkeypatch):
    calls = _count_calls(monkeypatch, W, "materialize")
    E.queries()["gold_published"](spark, SF_SMALL)
    assert len(calls) == 2


def test_silver_compacted_parses_the_messages_once(spark, monkeypatch):
    calls = _count_calls(monkeypatch, LQ.SV, "silver_trades")
    E.queries()["silver_compacted"](spark, SF_SMALL)
    plans = [bronze._jdf.queryExecution().optimizedPlan().toString() for bronze, *_ in calls]
    assert len(plans) == 4
    assert not [p for p in plans if "collect_list" in p or "from_json" in p]


def test_messages_sent_again_are_put_together_once(spark):
    raw = LQ.TD.raw_messages(LQ.TD.load_events(spark, SF_SMALL), duplicates=True)
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") and plan.count("Aggregate [") == 1


def test_dead_letters_puts_the_messages_together_once(spark, monkeypatch):
    calls = _count_calls(monkeypatch, LQ.L, "text_batch")
    got = {r.outcome: r.messages for r in E.queries()["dead_letters"](spark, SF_SMALL).collect()}
    assert calls and got["not_json"] == got["no_channel"] == got["routed"] + got["not_subscribed"]
    raw = spark.createDataFrame([('{"channel":"ticker","events":[{"tickers":[{"product_id":"A"}]}]}',), (None,)], "value string")
    assert R.classified(raw).columns == ["text", "channel", "product_id", "reason"]
