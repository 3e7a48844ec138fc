"""Incremental silver loads with an ingest high-water mark.

The mark is the greatest row of a small JSON table ``{"last_ingest_ts": ...}`` in a state folder. A load
reads the mark, keeps bronze rows with ``ingest_ts`` strictly greater (string order of
ISO-8601 UTC text; pushed down to the Parquet scan), appends the transformed increment and
then advances the mark to the increment's maximum. The plain append and the mark are not atomic
(a crash between them re-appends the increment on the next run); committed tables
(``sources.commits``, ``silver_job(dedup=True)``) and the streaming form are exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas as S
from marketlake.session import delete_path
from marketlake.sources.lake import data_files, path_exists, write_table


def read_mark(spark: SparkSession, state_dir: str) -> str | None:
    """The greatest stored mark, or None when no mark was written yet. A state folder
    without any mark file is an error: taking it for a first run would load all of bronze again."""
    if not path_exists(spark, state_dir):
        return None
    row = spark.read.schema(S.MARK_SCHEMA).json(state_dir).agg(F.max("last_ingest_ts").alias("mark"), F.count(F.lit(1)).alias("n")).first()
    if not row["n"]:
        raise ValueError(f"{state_dir} holds no mark; delete the folder to load everything again")
    return row["mark"] or None


def write_mark(spark: SparkSession, state_dir: str, value: str) -> None:
    """Add a marker file, then remove the older ones. Marks only grow and the greatest
    counts, so a crash at any point leaves the old mark or the new one."""
    old = data_files(spark, state_dir)
    spark.createDataFrame([(value,)], S.MARK_SCHEMA).coalesce(1).write.mode("append").json(state_dir)
    for path in old:
        delete_path(spark, path)


def increment(df: DataFrame, mark: str | None, col: str = "ingest_ts") -> DataFrame:
    """Rows strictly after the mark; everything when there is no mark. Rows with
    NULL ``ingest_ts`` never pass once a mark exists. Where bronze is partitioned by
    ``ingest_date``, folders more than a day before the mark are not read: stamps compare as
    text, and a stamp's UTC date is at most a day before its text's."""
    if mark is None:
        return df
    after = F.col(col) > F.lit(mark)
    if "ingest_date" in df.columns:
        day = F.date_sub(F.lit(mark[:10]).try_cast("date"), 1)
        after = after & (F.col("ingest_date").isNull() | day.isNull() | (F.col("ingest_date") >= day))
    return df.filter(after)


def max_mark(df: DataFrame, col: str = "ingest_ts") -> DataFrame:
    """The increment's greatest ingest time, one row ``last_ingest_ts``."""
    return df.agg(F.max(col).alias("last_ingest_ts"))


class Watched:
    """An increment whose greatest ingest time and number of rows are observed in whatever job reads
    ``rows`` (D8), before any unnest, so dropped messages still count."""

    def __init__(self, bronze: DataFrame, mark: str | None, col: str = "ingest_ts"):
        self.mark, self._increment = mark, increment(bronze, mark, col)
        self._measures = (F.max(col).alias("last_ingest_ts"), F.count(F.lit(1)).alias("rows"))
        self._obs = Observation("ingest_mark")
        self.rows = self._increment.observe(self._obs, *self._measures)

    def seen(self) -> tuple[str | None, int]:
        """(greatest ingest time, rows), after the job. Adaptive execution may have found that the job
        yields no rows and cut the observation off with the rest: then the increment is aggregated."""
        try:
            found = self._obs.get
        except Py4JJavaError:
            found = {}
        if "rows" not in found:
            found = self._increment.agg(*self._measures).first().asDict()
        return found["last_ingest_ts"], found["rows"]

    def report(self) -> dict:
        new, rows = self.seen()
        return {"written": rows > 0, "previous_mark": self.mark, "mark": self.mark if new is None else new, "bronze_rows": rows}


def incremental_append(
    spark: SparkSession,
    bronze: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    sink_path: str,
    state_dir: str,
    partition_by: Sequence[str] = S.SILVER_PARTITIONS,
    col: str = "ingest_ts",
    write: Callable[[DataFrame], None] | None = None,
    mark: str | None = None,
) -> dict:
    """One incremental load. Returns ``{"written", "previous_mark", "mark"}``.

    D3: an empty increment adds no rows and keeps the mark. Emptiness and the new mark are
    observed during the one write job (an ``Observation`` on the increment, before any
    unnest, so dropped messages still count); bronze is scanned once. A NULL maximum leaves
    the stored mark unchanged. ``write`` replaces the plain append of the transformed rows, ``mark`` the stored mark.
    """
    watched = Watched(bronze, mark or read_mark(spark, state_dir), col)
    (write or (lambda df: write_table(df, sink_path, partition_by, mode="append")))(transform(watched.rows))
    new_mark, _ = watched.seen()
    if new_mark is not None:
        write_mark(spark, state_dir, new_mark)
    return watched.report()
