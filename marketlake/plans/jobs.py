"""End-to-end jobs of the lake, one function per reference job.

Each takes a session and paths; none holds data on the driver. Typical wiring:

    bronze:  start_bronze(kafka_stream(...), "trades", bronze_path, ckpt)       (streaming)
    silver:  silver_job(spark, "trades", bronze_path, silver_path, state_dir)   (incremental)
    gold:    gold_job(spark, silver_trades_path, silver_ticker_path, gold_path) (full recompute)
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from marketlake import schemas as S
from marketlake.operators import bronze as B
from marketlake.operators import incremental as I
from marketlake.operators import keys as K
from marketlake.operators import quality as DQ
from marketlake.operators import silver as SV
from marketlake.plans import features as G
from marketlake.session import materialize, scratch_scope
from marketlake.sources import commits as C
from marketlake.sources import lake as L

BRONZE_SCHEMAS = {"trades": S.BRONZE_TRADES, "ticker": S.BRONZE_TICKER}
SILVER_SCHEMAS = {"trades": S.SILVER_TRADES, "ticker": S.SILVER_TICKER}
SILVER_FNS = {"trades": SV.silver_trades, "ticker": SV.silver_ticker}


# the columns that identify a row of each table
SILVER_KEYS = {"trades": ("product_id", "trade_id"), "ticker": ("product_id", "sequence_num")}
# the name under which the batch job keeps its mark in a committed table
JOB_STREAM = "silver_job"


def bronze_batch_job(spark: SparkSession, raw_path: str, kind: str, bronze_path: str, ingest_date: bool = False) -> None:
    """Batch form of C11/C12 (e.g. replaying archived topic files): append to bronze, with J6
    partitioned by ``ingest_date`` first, so that silver loads read recent folders only."""
    fn = B.bronze_trades if kind == "trades" else B.bronze_ticker
    parts = [*(["ingest_date"] if ingest_date else []), *S.BRONZE_PARTITIONS]
    L.write_table(fn(L.text_batch(spark, raw_path), ingest_date=ingest_date), bronze_path, parts, mode="append")


def read_bronze(spark: SparkSession, kind: str, path: str, ingest_date: bool = False) -> DataFrame:
    schema = BRONZE_SCHEMAS[kind]
    return L.read_table(spark, path, StructType([*schema.fields, StructField("ingest_date", DateType())]) if ingest_date else schema)


def read_lake(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A lake table, through its manifests if it has them."""
    return C.read_committed(spark, path, schema) if C.is_committed_table(spark, path) else L.read_table(spark, path, schema)


def store_load(spark: SparkSession, rows: DataFrame, kind: str, silver_path: str, stream: str, batch: int | None = None,
               mark: Callable[[], str | None] | None = None) -> C.State:
    """Add one copy of each key that no load holds yet, and the stream's mark or batch, as one
    commit. A batch that the stream has committed changes nothing; other streams, also those of
    a new checkpoint, never touch its rows. ``rows`` is computed once, into the shared folder;
    ``mark`` is asked after that. Where another writer commits meanwhile, the keys are compared again."""
    keys = SILVER_KEYS[kind]
    if batch is not None and C.read_state(spark, silver_path).batches.get(stream, -1) >= batch:
        return C.read_state(spark, silver_path)
    with scratch_scope(spark):
        first = materialize(DQ.keep_first(rows, keys, ("ingest_ts",)), "silver-load")
        for _ in range(10):
            before = C.read_state(spark, silver_path)
            load = C.new_load()
            fresh = K.not_stored(first, silver_path, before, keys)
            count = C.write_load(fresh, silver_path, S.SILVER_PARTITIONS, load)
            if count:
                K.write_index(spark, silver_path, load, count, first.schema, keys)
            try:
                return C.commit(spark, silver_path, C.appended(load, count, stream, batch, mark() if mark else None), based_on=before.number)
            except C.Conflict:
                continue
    raise C.Conflict(f"{silver_path}: other writers came first ten times")


def compact_silver(spark: SparkSession, kind: str, silver_path: str) -> C.State:
    """A5, A10: the loads of a deduplicated silver table as one, its keys indexed anew."""
    fields = list(SILVER_SCHEMAS[kind].fields)
    if kind == "ticker":
        fields[-2:-2] = [S.BRONZE_TICKER[c] for c in ("client_id", "sequence_num")]
    return C.compact(spark, silver_path, StructType(fields), S.SILVER_PARTITIONS, before_commit=lambda load, rows: K.write_index(
        spark, silver_path, load, rows, StructType(fields), SILVER_KEYS[kind]))


def silver_job(spark: SparkSession, kind: str, bronze_path: str, silver_path: str, state_dir: str, dedup: bool = False,
               validate: bool = False, quarantine_path: str | None = None, ingest_date: bool = False, enforce: bool = False) -> dict:
    """Incremental load of new bronze rows into silver.

    ``dedup`` (J1, J2) drops rows whose key silver holds already, whenever they arrive; silver is then
    a committed table, whose manifest takes rows and mark in one step (D9, A13), and ``state_dir``
    gives the mark of its first load only. ``validate``
    (J3, trades) sends rows that fail a check to ``quarantine_path`` with the reasons, ``enforce`` (J7) also
    rows with a value that its declared type cannot hold (``type:<column>``; without it such a value becomes
    NULL); the increment is written once to the shared folder and both tables are filled from there.
    ``ingest_date``: bronze is partitioned by it (J6) and pruned by the mark (D1)."""
    if (validate or enforce) and not quarantine_path:
        raise ValueError("validate and enforce need a quarantine_path")
    options = ({"keep_sequence": True} if dedup and kind == "ticker" else {}) | ({"report": "dq_lost"} if enforce else {})
    transform = partial(SILVER_FNS[kind], **options)
    bronze = read_bronze(spark, kind, bronze_path, ingest_date)
    stored = C.read_state(spark, silver_path).marks.get(JOB_STREAM) if dedup else None
    mark = stored or I.read_mark(spark, state_dir)
    load_id = hashlib.sha1(str(mark).encode()).hexdigest()[:12]

    def checked(rows: DataFrame) -> DataFrame:
        if not (validate or enforce):
            return rows
        checks = DQ.trade_checks() if validate else []
        marked = materialize(DQ.validate(rows, checks, lost="dq_lost" if enforce else None), "silver-checked")
        bad = marked.filter(~F.col("dq_valid")).drop("dq_valid").withColumn("load_id", F.lit(load_id))
        L.write_table(bad, quarantine_path, ["load_id"], mode="overwrite", dynamic_overwrite=True, rebalance=True)
        return marked.filter("dq_valid").drop("dq_reasons", "dq_valid")

    with scratch_scope(spark):
        if not dedup:
            return I.incremental_append(spark, bronze, transform, silver_path, state_dir, mark=mark, write=lambda rows: L.write_table(
                checked(rows), silver_path, S.SILVER_PARTITIONS, mode="append", rebalance=True))
        watched = I.Watched(bronze, mark)
        store_load(spark, checked(transform(watched.rows)), kind, silver_path, JOB_STREAM, mark=lambda: watched.seen()[0])
        return watched.report()


def gold_job(spark: SparkSession, trades_path: str, ticker_path: str, gold_path: str,
             dynamic_overwrite: bool = False, publish: bool = False, **feature_kw) -> dict:
    """F11 + A11: recompute the feature table and overwrite gold, partitioned by
    (product_id, event_date). The audit counts (F10) are observed during the write job
    itself, not by extra count() jobs. With ``publish`` gold is a committed table: the new rows are
    written beside the old ones, audited (as many as were counted on the way), and made visible by
    one switch, so that a failure before leaves the old gold readable (:func:`read_lake`)."""
    trades, ticker = read_lake(spark, trades_path, S.SILVER_TRADES), read_lake(spark, ticker_path, S.SILVER_TICKER)
    obs = Observation("gold_counts")
    keep = F.col("ma_500_trades").isNotNull() & F.col("target_return_10").isNotNull()
    with scratch_scope(spark):  # deletes the row index of this job, also when the write fails
        unfiltered = G.build_features(trades, ticker, apply_filter=False, **feature_kw)
        observed = unfiltered.observe(obs, F.count(F.lit(1)).alias("records_before_filter"),
                                      F.count(F.when(keep, F.lit(1))).alias("records_after_filter"))
        def audit(rows: int) -> None:
            if rows != (counted := obs.get["records_after_filter"]):
                raise ValueError(f"gold has {rows} rows where {counted} were counted: not published")

        if publish:
            # the windows' tasks hold ranges of (product, time): few folders each, no second shuffle of the wide rows
            C.overwrite(G.final_filter(observed), gold_path, S.GOLD_PARTITIONS, check=audit, rebalance=False)
        else:
            L.write_table(G.final_filter(observed), gold_path, S.GOLD_PARTITIONS, mode="overwrite", dynamic_overwrite=dynamic_overwrite)
    m = dict(obs.get)
    m["records_removed"] = m["records_before_filter"] - m["records_after_filter"]
    # counts without columns: answered from the files' footers
    return m | {"input_trades": trades.count(), "input_ticker": ticker.count()}
