"""Invariants of the feature table on the driver's sf0.001 data."""

from __future__ import annotations

from conftest import SF_SMALL
from pyspark.sql import functions as F

from marketlake.plans import features as G
from marketlake.sources import lake as L
from marketlake.sources import testdata as TD


def test_join_keeps_rows_and_invariants_hold(spark):
    ev = TD.load_events(spark, SF_SMALL)
    trades, ticker = TD.trades(ev), TD.ticker(ev)
    g = G.build_features(trades, ticker, apply_filter=False, index_col="seq")
    assert g.count() == trades.count()  # the left join keeps trades 1:1
    eps = 1e-9
    bad = g.filter(
        ((F.col("min_10_trades") - eps > F.col("ma_10_trades")) | (F.col("ma_10_trades") > F.col("max_10_trades") + eps))
        | ((F.col("min_100_trades") - eps > F.col("ma_100_trades")) | (F.col("ma_100_trades") > F.col("max_100_trades") + eps))
        | (F.col("buy_count_50") + F.col("sell_count_50") > F.least(F.lit(50), F.col("seq") + 1))
        | (F.col("buy_count_100") + F.col("sell_count_100") > F.least(F.lit(100), F.col("seq") + 1))
        | (F.col("volume_50") + eps < F.col("buy_volume_50") + F.col("sell_volume_50"))
        | (F.col("price_range_50") < 0)
        | ((F.col("seq") < 10) != F.col("price_change_10").isNull())
    )
    assert bad.count() == 0
    # the per-product index is dense
    per = g.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("mx")).collect()
    assert all(r["n"] == r["mx"] + 1 for r in per)


def test_kafka_options():
    opts = L.kafka_options("b:9092", "crypto.trades.raw")
    assert opts == {"kafka.bootstrap.servers": "b:9092", "subscribe": "crypto.trades.raw",
                    "startingOffsets": "latest", "failOnDataLoss": "false"}


def test_partitions_for_uses_size_estimate(spark):
    from marketlake.session import partitions_for
    ev = TD.load_events(spark, SF_SMALL)
    base = spark.sparkContext.defaultParallelism
    assert partitions_for(ev) == base  # tiny input: one partition per task slot
    assert partitions_for(ev, target_bytes=1) > base  # one partition per estimated byte, capped
    assert partitions_for(ev, target_bytes=1, max_partitions=1000) == 1000
