"""Silver (D4-D7, J7): bronze rows -> typed, flat silver rows. Map-only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake import schemas as S
from marketlake.operators.flatten import items, lost_values, shaped


def silver_ticker(bronze: DataFrame, keep_sequence: bool = False, report: str | None = None) -> DataFrame:
    """INNER unnest of events and tickers (messages without tickers disappear), rename,
    numbers to double (bad text -> NULL). ``keep_sequence`` also carries ``client_id`` and
    ``sequence_num`` for ticker dedup (J2); ``report`` names a column for the numbers lost (J7)."""
    sources = {silver: payload for payload, silver in S.TICKER_NUMERIC_COLUMNS} | {"event_ts": "timestamp"}
    fields = list(S.SILVER_TICKER.fields)
    if keep_sequence:
        fields[-2:-2] = [bronze.schema["client_id"], bronze.schema["sequence_num"]]
    return shaped(items(bronze, "tickers", outer=False), StructType(fields), sources, report)


def silver_trades(bronze: DataFrame, report: str | None = None) -> DataFrame:
    """Rename ``timestamp`` -> ``event_ts``; (re)cast price and size; ``report`` as for tickers."""
    return shaped(bronze, S.SILVER_TRADES, {"event_ts": "timestamp"}, report)


def enforce_schema(df: DataFrame, schema: StructType, report: str | None = None) -> DataFrame:
    """Project to a declared schema (name, type, order); missing columns are an error,
    extra columns are dropped, types are converted with try_cast (bad values -> NULL). With
    ``report`` an array column of that name lists the columns whose value did not convert."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for schema: {missing}")
    columns = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    if report:
        columns.append(lost_values({f.name: (F.col(f.name), f.dataType) for f in schema.fields}).alias(report))
    return df.select(*columns)
