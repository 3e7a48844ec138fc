"""Bronze (C1-C12, J6): raw topic records -> typed bronze rows. Stateless and map-only, so
the same functions serve a batch DataFrame and a streaming one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from marketlake import schemas as S
from marketlake.functions import utc_time
from marketlake.operators.flatten import items, shaped


def parse_messages(raw: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """bytes/text -> typed envelope columns (permissive: text that is not
    JSON gives all-NULL columns, a wrongly typed field is NULL alone; the row survives)."""
    message = F.from_json(F.col(value_col).cast("string"), schema)
    return raw.select(F.coalesce(message, F.from_json(F.lit("{}"), schema)).alias("m")).select("m.*")


def with_event_partition(df: DataFrame, ts_col: str = "timestamp", ingest_date: bool = False) -> DataFrame:
    """``event_date`` and ``event_hour`` of the envelope time (NULL when unparsable).
    J6 (opt-in): ``ingest_date`` from ``ingest_ts``."""
    t = utc_time(ts_col)
    out = df.withColumn("event_date", F.to_date(t)).withColumn("event_hour", F.hour(t))
    if ingest_date:
        out = out.withColumn("ingest_date", F.to_date(utc_time("ingest_ts")))
    return out


def _bronze(rows: DataFrame, schema: StructType, sources: dict[str, str], ingest_date: bool) -> DataFrame:
    dated = with_event_partition(rows, ingest_date=ingest_date)
    wanted = StructType([*schema.fields, StructField("ingest_date", DateType())]) if ingest_date else schema
    return shaped(dated, wanted, sources)


def bronze_ticker(raw: DataFrame, value_col: str = "value", ingest_date: bool = False) -> DataFrame:
    """C11: ticker messages keep their nesting; adds event_hour, event_date."""
    return _bronze(parse_messages(raw, S.TICKER_MESSAGE, value_col), S.BRONZE_TICKER, {}, ingest_date)


def bronze_trades(raw: DataFrame, value_col: str = "value", ingest_date: bool = False) -> DataFrame:
    """One row per trade. Both unnest steps are OUTER (C7, C8): a message without
    events or trades still leaves one row, with NULL trade fields."""
    rows = items(parse_messages(raw, S.TRADES_MESSAGE, value_col), "trades", outer=True)
    return _bronze(rows, S.BRONZE_TRADES, {"trade_time": "time"}, ingest_date)
