"""Nested messages to flat rows, driven by the declared table schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StructType

from marketlake.functions import to_double


def items(messages: DataFrame, payload: str, outer: bool) -> DataFrame:
    """One row per item of the ``payload`` list of each event, item fields as columns beside
    the envelope's; ``event_type`` is the event's own. ``outer`` keeps messages without items."""
    unnest = F.explode_outer if outer else F.explode  # not inline: unused item fields stay unread
    envelope = [F.col(c) for c in messages.columns if c != "events"]
    event = messages.select(*envelope, unnest("events").alias("event"))
    item = event.select(*envelope, F.col("event.type").alias("event_type"), unnest(f"event.{payload}").alias("item"))
    return item.select(*envelope, "event_type", "item.*")


def shaped(rows: DataFrame, schema: StructType, sources: Mapping[str, str], report: str | None = None) -> DataFrame:
    """The columns of ``schema`` in its order, each from the column ``sources`` names (default:
    its own name); numbers are converted, bad text becomes NULL. With ``report`` an array column of
    that name lists the columns whose value was lost so (J7)."""
    def one(name: str, number: bool):
        source = sources.get(name, name)
        return (to_double(source) if number else F.col(source)).alias(name)
    columns = [one(f.name, isinstance(f.dataType, DoubleType)) for f in schema.fields]
    if report:
        numbers = {f.name: (F.col(sources.get(f.name, f.name)), f.dataType) for f in schema.fields if isinstance(f.dataType, DoubleType)}
        columns.append(lost_values(numbers).alias(report))
    return rows.select(*columns)


def lost_values(columns: Mapping[str, tuple[Column, DataType]]) -> Column:
    """The names of the columns that hold a value which their declared type cannot."""
    return F.array_compact(F.array(*(F.when(c.isNotNull() & c.try_cast(t).isNull(), F.lit(name)) for name, (c, t) in columns.items())))
