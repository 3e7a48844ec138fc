from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from marketlake.session import get_session, use_local_folder

    s = get_session("local[4]", app_name="marketlake-tests", shuffle_partitions=8)
    use_local_folder(s)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def trade_rows(spark, rows, columns=("product_id", "event_ts", "trade_id", "price", "size", "side")):
    """Silver-trades-like rows from tuples (missing silver columns filled with defaults)."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "product_id string, event_ts string, trade_id string, price double, "
                                     "size double, side string")
    return df.select(
        F.lit("market_trades").alias("channel"), "event_ts",
        F.concat(F.col("event_ts"), F.lit("")).alias("ingest_ts"), F.lit("ws_public").alias("source"),
        F.lit("update").alias("event_type"), F.lit(0).alias("event_hour"), "trade_id", "price", "size",
        F.col("event_ts").alias("trade_time"), "side", F.lit(None).cast("date").alias("event_date"), "product_id",
    )


def ticker_rows(spark, rows):
    return spark.createDataFrame(rows, "product_id string, event_ts string, ingest_ts string, best_bid double, "
                                       "best_ask double")
