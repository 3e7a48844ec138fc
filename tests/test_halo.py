"""Property test: the halo-chunked window equals the reference's per-product window on
random data with a hot product, NULL times, a NULL product and repeated timestamps."""

from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import trade_rows

from marketlake.operators import windows as W
from marketlake.plans import features as G


def _random_trades(spark, n: int, seed: int):
    rng = np.random.default_rng(seed)
    products = rng.choice(["HOT", "A", "B", None], size=n, p=[0.6, 0.25, 0.14, 0.01])
    minutes = rng.integers(0, 400, size=n)
    rows = []
    for i in range(n):
        ts = None if rng.random() < 0.01 else f"2024-01-{1 + minutes[i] // 60 % 28:02d}T{minutes[i] % 24:02d}:{minutes[i] % 60:02d}:00Z"
        price = float(rng.integers(0, 50))  # contains 0 prices
        size = float(rng.integers(0, 10))
        side = rng.choice(["BUY", "SELL", None], p=[0.5, 0.45, 0.05])
        rows.append((products[i], ts, str(i), price, size, side))
    return trade_rows(spark, rows)


FEATURES = W.TRADE_FEATURE_ORDER + W.TARGET_ORDER


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("chunk_rows,num_partitions", [(499, 3), (500, 8), (777, 5), (4096, 2)])
def test_halo_equals_plain(spark, chunk_rows, num_partitions):
    t = G.parse_times(_random_trades(spark, 3000, seed=chunk_rows))
    plain = {r["trade_id"]: r for r in G.trade_features(t, strategy="plain").collect()}
    halo = {r["trade_id"]: r for r in G.trade_features(t, strategy="halo", chunk_rows=chunk_rows,
                                                       num_partitions=num_partitions).collect()}
    assert plain.keys() == halo.keys()
    bad = [(k, c, plain[k][c], halo[k][c]) for k in plain for c in FEATURES if not _close(plain[k][c], halo[k][c])]
    assert not bad, bad[:5]


def test_row_index_is_dense_per_key(spark):
    t = G.parse_times(_random_trades(spark, 2000, seed=7))
    idx = W.row_index(t, ["product_id"], ["event_ts_dt", "trade_id"], num_partitions=6)
    got = {}
    for r in idx.select("product_id", "_r").collect():
        got.setdefault(r["product_id"], []).append(r["_r"])
    for k, v in got.items():
        assert sorted(v) == list(range(len(v))), k


def test_chunk_rows_below_lookback_rejected(spark):
    t = G.parse_times(_random_trades(spark, 10, seed=1))
    with pytest.raises(ValueError):
        G.trade_features(t, strategy="halo", chunk_rows=100)


def _random_ticker(spark, n: int, seed: int):
    from conftest import ticker_rows
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        m = int(rng.integers(0, 400))
        ts = f"2024-01-{1 + m // 60 % 28:02d}T{m % 24:02d}:{m % 60:02d}:{int(rng.integers(0, 60)):02d}Z"
        bid = float(rng.integers(-5, 50))
        ask = None if rng.random() < 0.1 else bid + 10
        rows.append((str(rng.choice(["HOT", "A", "B", "C"])), ts, f"i{i:05d}", bid, ask))
    return ticker_rows(spark, rows)


@pytest.mark.parametrize("chunk_rows", [499, 777])
def test_gold_halo_with_quotes_in_exchange_equals_plain_join(spark, chunk_rows):
    trades, ticker = _random_trades(spark, 2500, seed=chunk_rows + 1), _random_ticker(spark, 800, seed=chunk_rows)
    plain = {r["trade_id"]: r for r in G.build_features(trades, ticker, strategy="plain", apply_filter=False).collect()}
    halo = {r["trade_id"]: r for r in G.build_features(trades, ticker, chunk_rows=chunk_rows, num_partitions=4,
                                                       apply_filter=False, quote_join="window").collect()}
    assert plain.keys() == halo.keys()
    cols = list(next(iter(plain.values())).asDict())
    bad = [(k, c, plain[k][c], halo[k][c]) for k in plain for c in cols if not _close(plain[k][c], halo[k][c])]
    assert not bad, bad[:5]
    assert sum(1 for r in plain.values() if r["best_bid"] is not None) > 50  # quotes really matched


@pytest.mark.parametrize("order_kw", [{"order_by": "trade_time"}, {"numeric_trade_id": True}])
def test_gold_ordering_options_halo_equals_plain(spark, order_kw):
    trades, ticker = _random_trades(spark, 1500, seed=5), _random_ticker(spark, 400, seed=6)
    plain = {r["trade_id"]: r for r in G.build_features(trades, ticker, strategy="plain", apply_filter=False,
                                                        **order_kw).collect()}
    halo = {r["trade_id"]: r for r in G.build_features(trades, ticker, chunk_rows=600, num_partitions=3,
                                                       apply_filter=False, quote_join="window",
                                                       **order_kw).collect()}
    assert plain.keys() == halo.keys()
    cols = list(next(iter(plain.values())).asDict())
    assert len(cols) == 77
    bad = [(k, c, plain[k][c], halo[k][c]) for k in plain for c in cols if not _close(plain[k][c], halo[k][c])]
    assert not bad, bad[:5]
