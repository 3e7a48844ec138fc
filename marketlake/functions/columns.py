"""Column expressions shared by the layers. All are built-in Spark functions (JVM, codegen).

They pin the semantics of the reference's Spark 3.3 non-ANSI code under Spark 4's ANSI
default: malformed numbers and times become NULL, an unguarded division by zero is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: str | Column) -> Column:
    """String/number -> double; text that is no number gives NULL (never an error)."""
    return _c(c).try_cast("double")


def utc_time(c: str | Column) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ holding the UTC wall clock; unparsable text -> NULL.

    The offset in the text is honoured (``Z``, ``+00:00``, ``+02:00`` ...), and the result
    does not depend on the session time zone.
    """
    return instant_to_utc_ntz(F.try_to_timestamp(_c(c)))


def instant_to_utc_ntz(instant: Column) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ of its UTC wall clock, via epoch microseconds,
    so no session-zone conversion (ambiguous in a daylight-saving overlap) takes part."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def bucket_time(unit: str, ts: str | Column) -> Column:
    """Truncate a TIMESTAMP_NTZ to ``unit`` and keep it TIMESTAMP_NTZ.

    Built from the wall-clock fields, so no session-zone round trip is involved (Spark's
    ``date_trunc`` on NTZ input goes through the session zone, which shifts wall clocks
    that fall into a daylight-saving gap).
    """
    t = _c(ts)
    zero = F.lit(0)
    fields = {
        "second": (F.hour(t), F.minute(t), F.floor(F.second(t))),
        "minute": (F.hour(t), F.minute(t), zero),
        "hour": (F.hour(t), zero, zero),
        "day": (zero, zero, zero),
    }
    if unit not in fields:
        return F.date_trunc(unit, t).cast("timestamp_ntz")
    h, m, s = fields[unit]
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), h, m, s)


def pct_change(new: str | Column, old: str | Column) -> Column:
    """(new - old) / old * 100; NULL when old is 0 or either side is NULL."""
    new, old = _c(new), _c(old)
    return F.try_divide(new - old, old) * 100


def pct_distance(value: str | Column, ref: str | Column) -> Column:
    """(value - ref) / ref * 100 when ref > 0, else 0 (NULL ref counts as not > 0)."""
    value, ref = _c(value), _c(ref)
    return F.when(ref.isNotNull() & (ref > 0), (value - ref) / ref * 100).otherwise(F.lit(0.0))


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den when den > 0, else 0."""
    num, den = _c(num), _c(den)
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def is_side(side: str | Column, value: str) -> Column:
    """1 when the trade side equals ``value``, else 0 (NULL side -> 0)."""
    return F.when(_c(side) == value, F.lit(1)).otherwise(F.lit(0))
