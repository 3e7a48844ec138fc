"""Plan-shape tests: the physical plans we rely on for scale."""

from __future__ import annotations

from conftest import SF_SMALL

from marketlake.plans import features as G
from marketlake.plans import lake_queries as LQ
from marketlake.sources import testdata as TD


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_halo_window_is_not_partitioned_by_product_alone(spark):
    import re
    ev = TD.load_events(spark, SF_SMALL)
    plan = _plan(G.build_features(TD.trades(ev), TD.ticker(ev), chunk_rows=512, quote_join="window"))
    specs = re.findall(r"Window \[.*?\], \[(.*?)\], \[(.*?)\]", plan)
    feature_windows = [p for p, o in specs if "_r#" in o]
    assert feature_windows and all("_chunk" in p for p in feature_windows), specs
    # the reference's per-product trade window (one task per product) is absent
    assert not [p for p, o in specs if "event_ts_dt" in o]
    # quotes are attached inside the halo exchange: no join of the trades with the quotes
    assert "LeftOuter" not in plan


def test_auto_quote_join_broadcasts_only_a_small_quote_side(spark):
    ev = TD.load_events(spark, SF_SMALL)
    small = _plan(G.build_features(TD.trades(ev), TD.ticker(ev)))
    import re
    assert re.search(r"BroadcastHashJoin \[[^\n]*LeftOuter", small), small
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # nothing counts as small
        big = _plan(G.build_features(TD.trades(ev), TD.ticker(ev)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "LeftOuter" not in big and "_is_quote" in big


def test_plain_gold_plan_exchanges(spark):
    ev = TD.load_events(spark, SF_SMALL)
    plan = _plan(G.build_features(TD.trades(ev), TD.ticker(ev), strategy="plain"))
    # one shuffle for the trade window (leads included), one for the quote aggregation,
    # one per join side; no second trade-window shuffle after the join
    import re
    assert len(re.findall(r"Exchange hashpartitioning\(product_id#\d+, \d+\)", plan)) == 1, plan
    assert plan.count("Exchange") <= 4, plan


def test_silver_ticker_prunes_nested_event_type(spark, tmp_path):
    from marketlake import schemas as S
    from marketlake.operators import bronze as B
    from marketlake.operators import silver as SV
    from marketlake.sources import lake as L
    raw = TD.raw_messages(TD.load_events(spark, SF_SMALL), channel="ticker")
    L.write_table(B.bronze_ticker(raw), str(tmp_path / "b"), S.BRONZE_PARTITIONS)
    plan = _plan(SV.silver_ticker(L.read_table(spark, str(tmp_path / "b"))))
    schema = plan[plan.index("ReadSchema: "):].split("\n")[0]
    assert "events:array<struct<tickers:" in schema and "client_id" not in schema, schema


def test_plain_strategy_has_single_window_shuffle_before_join(spark):
    ev = TD.load_events(spark, SF_SMALL)
    df = G.build_features(TD.trades(ev), TD.ticker(ev), strategy="plain")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # leads are computed together with the lags before the join: one Window operator
    # over the trade order, not a second one after the join
    assert plan.count("Window [") == 1, plan


def test_quote_pick_uses_partial_aggregation(spark):
    ev = TD.load_events(spark, SF_SMALL)
    from marketlake.operators import quotes as Q
    q = Q.last_per_bucket(G.parse_times(TD.ticker(ev).select("product_id", "event_ts", "ingest_ts",
                                                                "best_bid", "best_ask")))
    plan = _plan(q)
    assert "partial_max_by" in plan


def test_ticker_scan_is_pruned(spark):
    ev = TD.load_events(spark, SF_SMALL)
    df = G.build_features(TD.trades(ev), TD.ticker(ev), strategy="plain")
    plan = _plan(df)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in plan


def test_partition_pruning(spark):
    df = LQ.partition_pruned_read(spark, SF_SMALL)
    plan = _plan(df)
    assert "PartitionFilters" in plan and "product_id" in plan and "event_date" in plan
    assert df.count() > 0
