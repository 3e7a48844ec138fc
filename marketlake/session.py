"""SparkSession construction and the few session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library expects. The zone is pinned to UTC like the feed's
# instants; the library's own time parsing and bucketing do not depend on it.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # streaming dedup state lives off-heap in RocksDB, not in executor heap maps
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(
    master: str | None = None,
    app_name: str = "marketlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones at runtime).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that the driver and all executors share: the one
    named in ``spark.checkpoint.dir``, or else the one given to ``setCheckpointDir``. There is
    no fallback: a folder of one machine's own would lose rows on a cluster."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext behind this session
            configured = None
    if not configured:
        raise ValueError("no shared folder: name one in spark.checkpoint.dir")
    return configured.rstrip("/")


def use_local_folder(spark: SparkSession, folder: str | None = None) -> str:
    """For tests and single-machine runs: use ``folder`` (default: a new temporary one) where
    the session names none. Refuses on a cluster, whose executors would not see it."""
    try:
        return shared_folder(spark)
    except ValueError:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise
    spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="marketlake-"))
    return shared_folder(spark)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for written intermediate tables."""
    return f"{shared_folder(spark)}/marketlake-scratch/{name}"


_SCOPE: ContextVar[list[str] | None] = ContextVar("marketlake_scratch_scope", default=None)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table under the shared folder and read it back.
    Compact and column-prunable (unlike a row checkpoint), and every later reader sees the same
    rows even when ``df`` holds nondeterministic values. Inside a :func:`scratch_scope` the
    table is deleted when the scope ends; else it stays for the folder's retention, as the
    returned DataFrame is lazy and its reader is not known here."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("error").parquet(path)
    if (own := _SCOPE.get()) is not None:
        own.append(path)
    return spark.read.schema(df.schema).parquet(path)  # known schema: no footer-inference job


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that :func:`materialize` writes inside the ``with`` block are deleted at its end,
    also after an error, and no others: scopes of other jobs and threads are their own."""
    own: list[str] = []
    token = _SCOPE.set(own)
    try:
        yield own
    finally:
        _SCOPE.reset(token)
        for path in own:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder through the cluster's file system; False where the session has
    no access to it (Spark Connect)."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no JVM access: leave it for the folder's retention
        return False
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).delete(p, True))


def small_methods(spark: SparkSession) -> None:
    """For plans over wide rows: let Spark compile in one method only what HotSpot compiles too (8000 bytes; a longer
    method is interpreted, several times slower), and split the rest. A limit that the session sets stays."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":  # Spark's default
        spark.conf.set(name, "8000")


def small_batches(spark: SparkSession) -> None:
    """For texts handed to Python: batches of up to 4 MB, as each is held several times on its way (in the JVM, in
    its worker, as strings). Rows come out the same. A limit that the session sets stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":  # Spark's default
        spark.conf.set(name, str(4 << 20))


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (no job runs); None when unknown."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - statistics are an optimisation only
        return None
    return None if size >= (1 << 62) else size


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: broadcasting disabled)."""
    try:
        return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    except Exception:  # noqa: BLE001
        return -1


def partitions_for(df: DataFrame, target_bytes: int = 256 << 20, max_partitions: int = 1_000_000) -> int:
    """Partition count for a shuffle of ``df`` that AQE must not coalesce: one per
    ``target_bytes`` of Catalyst's size estimate (file sizes of the scanned columns; no job
    runs), never fewer than the cluster's default parallelism (its total task slots), so
    every core has work and no partition outgrows memory. An unknown estimate (Spark's
    default of Long.MaxValue) falls back to ``spark.sql.shuffle.partitions``."""
    spark = df.sparkSession
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = estimated_bytes(df)
    if size is None:
        return configured
    try:
        floor = int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
        floor = configured
    return int(min(max(floor, -(-size // target_bytes)), max_partitions))
