"""Raw messages of one channel."""

from __future__ import annotations

import datetime as dt

from marketlake import schemas as S
from marketlake.sources import testdata as TD


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_one_channel_gathers_its_own_payload_only(spark):
    rows = [(i, dt.datetime(2024, 1, 1, 0, 0, i % 3), i % 4, "view" if i % 2 else "buy", 1.5 + i, '{"k": 2}') for i in range(24)]
    ev = spark.createDataFrame([*rows, *rows[:3]], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    every = sorted(r.value for r in TD.raw_messages(ev).collect())
    found = []
    for channel in (S.CHANNEL_TRADES, S.CHANNEL_TICKER):
        one = TD.raw_messages(ev, channel=channel)
        found += [r.value for r in one.collect()]
        aggregate = next(line for line in _plan(one).splitlines() if "Aggregate" in line)
        assert aggregate.count("collect_list") == 1
    assert sorted(found) == every
