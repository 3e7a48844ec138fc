"""F11 by increments: gold follows new loads of silver without recomputing history.

Silver tables are committed tables (:mod:`marketlake.sources.commits`); gold's manifest states which of their
loads it holds and, of every gold load, the dates that are visible. An increment

1. reads the new loads of trades and ticker alone and notes the (product, date) folders they touch;
2. numbers the rows of each product by the counts of its folders (partition columns alone are read).
   A trade's features rest on the 499 rows before and the 50 after it, so a folder is dirty if it
   is touched, if fewer than 499 rows part it from a touched one before it, or fewer than 50 from
   one after it; a new quote makes its own folder dirty;
3. builds features from the dirty folders and as many around them as hold these rows, and keeps the
   rows of the dirty ones. Of the dates concerned, the other products' rows are copied;
4. commits one load that takes the place of these dates. Until then, and after a crash, readers see
   the gold before.

The result equals a full build (late and repeated dates as well). A full build is done where no increment
can be right: the first time, or when silver loads that gold holds are gone (compaction, overwrite).
Rows lie in the folder of their time's date; a load with others is refused.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake import schemas as S
from marketlake.functions import utc_time
from marketlake.operators import windows as W
from marketlake.plans import features as G
from marketlake.session import materialize, scratch_scope
from marketlake.sources import commits as C

FOLDER = ("product_id", "event_date")


def _on_dates(dates: Iterable[str | None]) -> Column:
    """Whether a row's folder is of one of ``dates``; a filter of folders."""
    known = [F.lit(d).cast("date") for d in dates if d is not None]
    hit = F.col("event_date").isin(known) if known else F.lit(False)
    return hit | F.col("event_date").isNull() if None in dates else F.coalesce(hit, F.lit(False)) if not known else hit


def _same_folder(a: DataFrame, b: DataFrame) -> Column:
    return reduce(and_, (a[c].eqNullSafe(b[c]) for c in FOLDER))


def read_gold(spark: SparkSession, path: str, schema: StructType, state: C.State | None = None) -> DataFrame:
    """The visible rows of an incremental gold table: of every load the dates that no later one replaced."""
    state = state or C.read_state(spark, path)
    rows = C.read_committed(spark, path, schema, state, with_load=True)
    if any(state.loads.values()):
        rows = rows.where(reduce(or_, ((F.col("load_id") == load) & _on_dates(state.dates[load]) if load in state.dates
                                       else F.col("load_id") == load for load in state.loads)))
    return rows.drop("load_id")


def touched_folders(rows: DataFrame) -> DataFrame:
    """The folders of ``rows``, each once. Raises on rows outside the folder of their time's date."""
    day = F.to_date(utc_time("event_ts"))
    found = rows.groupBy(*FOLDER).agg(F.max(~day.eqNullSafe(F.col("event_date"))).alias("astray"))
    stop = F.raise_error(F.lit("rows outside the folder of their date")).cast("boolean")
    return found.select(*FOLDER, F.when(F.col("astray"), stop).otherwise(F.lit(True)).alias("touched"))


def _around(folders: DataFrame, flag: str, before: int, after: int, name: str) -> DataFrame:
    """``folders`` (with first and last row number ``lo``, ``hi``) with ``name``: whether one is flagged, or
    lies fewer than ``before`` rows before, or ``after`` rows after, a flagged one."""
    w = Window.partitionBy("product_id").orderBy(F.col("event_date").asc_nulls_first())
    last = F.max(F.when(F.col(flag), F.col("hi"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    following = F.min(F.when(F.col(flag), F.col("lo"))).over(w.rowsBetween(1, Window.unboundedFollowing))
    near = (F.coalesce(F.col("lo") - last < after, F.lit(False))) | (F.coalesce(following - F.col("hi") < before, F.lit(False)))
    return folders.withColumn(name, F.col(flag) | near)


def dirty_folders(trades: DataFrame, new_trades: DataFrame, new_ticker: DataFrame) -> DataFrame:
    """(product_id, event_date, dirty, needed) of every folder of ``trades``: whether its features change, and
    whether its rows are read for those that do. A row per product and date."""
    w = Window.partitionBy("product_id").orderBy(F.col("event_date").asc_nulls_first())
    sizes = trades.groupBy(*FOLDER).agg(F.count(F.lit(1)).alias("n")).withColumn("hi", F.sum("n").over(w))
    sizes = sizes.withColumn("lo", F.col("hi") - F.col("n"))
    for rows, flag in ((new_trades, "traded"), (new_ticker, "quoted")):
        marks = touched_folders(rows)
        sizes = sizes.join(marks, _same_folder(sizes, marks), "left").select(
            *(sizes[c] for c in sizes.columns), F.coalesce(marks["touched"], F.lit(False)).alias(flag))
    dirty = _around(sizes, "traded", W.LOOKAHEAD, W.LOOKBACK, "near").withColumn("dirty", F.col("near") | F.col("quoted"))
    return _around(dirty, "dirty", W.LOOKBACK, W.LOOKAHEAD, "needed").select(*FOLDER, "dirty", "needed")


def _dates(folders: DataFrame, flag: str) -> list[str | None]:
    """The distinct dates of flagged folders: as many as days, whatever the number of rows."""
    return [r.d for r in folders.where(flag).select(F.col("event_date").cast("string").alias("d")).distinct().collect()]


def _of(rows: DataFrame, folders: DataFrame, how: str = "left_semi") -> DataFrame:
    return rows.join(folders, _same_folder(rows, folders), how)


def gold_increment(spark: SparkSession, trades_path: str, ticker_path: str, gold_path: str, **feature_kw) -> dict:
    """Bring gold up to the visible loads of silver. Returns ``full`` (a full build was done), ``dates`` replaced
    and ``rows`` written; an increment without new loads writes nothing. Another writer of the
    same gold raises :class:`~marketlake.sources.commits.Conflict`."""
    gold = C.read_state(spark, gold_path)
    sources = {"trades": (trades_path, S.SILVER_TRADES), "ticker": (ticker_path, S.SILVER_TICKER)}
    states = {k: C.read_state(spark, path) for k, (path, _) in sources.items()}
    held = {k: set(filter(None, gold.marks.get(k, "").split(","))) for k in sources}
    fresh = {k: {load: n for load, n in s.loads.items() if load not in held[k]} for k, s in states.items()}
    full = not gold.marks or any(held[k] - s.loads.keys() for k, s in states.items())
    marks = gold.marks | {k: ",".join(sorted(s.loads)) for k, s in states.items()}
    if not full and not any(n for loads in fresh.values() for n in loads.values()):
        return {"full": False, "dates": [], "rows": 0}

    def rows_of(kind: str, loads: dict[str, int]) -> DataFrame:
        path, schema = sources[kind]
        return C.read_committed(spark, path, schema, replace(states[kind], loads=loads))

    trades, ticker = (rows_of(k, states[k].loads) for k in sources)
    new = {k: states[k].loads if full else fresh[k] for k in sources}
    with scratch_scope(spark):
        folders = materialize(dirty_folders(trades, rows_of("trades", new["trades"]), rows_of("ticker", new["ticker"])), "gold-folders")
        dates = _dates(folders, "dirty")
        dirty, needed = folders.where("dirty").select(*FOLDER), folders.where("needed").select(*FOLDER)
        context = _of(trades.where(_on_dates(_dates(folders, "needed"))), needed)
        built = G.build_features(context, ticker.where(_on_dates(dates)), **feature_kw)
        rows = _of(built, dirty)
        if not full:  # products of these dates that nothing has touched
            old = read_gold(spark, gold_path, built.schema, gold).where(_on_dates(dates))
            rows = rows.unionByName(_of(old, dirty, "left_anti"))
        load = C.new_load()
        count = C.write_load(rows, gold_path, S.GOLD_PARTITIONS, load)

    def change(s: C.State) -> C.State:
        left = {} if full else {k: [d for d in shown if d not in dates] for k, shown in s.dates.items() if k in s.loads}
        loads = {k: n for k, n in s.loads.items() if left.get(k)}
        return replace(s, loads=loads | {load: count}, marks=marks, dates={k: left[k] for k in loads} | {load: dates})

    C.commit(spark, gold_path, change, based_on=gold.number)
    return {"full": full, "dates": sorted(dates, key=str), "rows": count}
