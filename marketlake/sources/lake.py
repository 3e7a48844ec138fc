"""Lake readers and writers (A5-A11, A14, A15, H1-H3) and raw-record sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

# ------------------------------------------------------------------ raw record sources


def kafka_options(bootstrap: str, topic: str, starting_offsets: str = "latest",
                  fail_on_data_loss: bool = False, **extra: str) -> dict[str, str]:
    """A1-A4: options of the topic source (start at the latest offsets when no checkpoint
    exists; tolerate offsets that expired from the broker)."""
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
    }
    opts.update(extra)
    return opts


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str, **kw) -> DataFrame:
    """Streaming topic records (binary ``key``/``value`` ...). Needs the Kafka connector
    package on the cluster's classpath."""
    return spark.readStream.format("kafka").options(**kafka_options(bootstrap, topic, **kw)).load()


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stand-in for a topic: one raw message per line, column ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def text_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


# ------------------------------------------------------------------ lake tables


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's Hadoop FileSystem (object stores included)."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): probe with a read
        try:
            spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
            return True
        except Exception:  # noqa: BLE001
            return False
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files directly in a folder (none if it does not exist)."""
    if not path_exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return [s.getPath().toString() for s in found if s.isFile() and not s.getPath().getName().startswith(("_", "."))]


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds any data file, at any depth (no file is opened)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A partitioned Parquet lake table. With ``schema`` the read schema is fixed
    (no footer inference; nested fields not in it are never read)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def as_view(spark: SparkSession, path: str, schema: StructType, name: str) -> str:
    """A temporary view of a lake table, for SQL text; partition filters prune folders."""
    read_table(spark, path, schema).createOrReplaceTempView(name)
    return name


def write_table(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "append",
                dynamic_overwrite: bool = False, compression: str = "snappy", rebalance: bool = False) -> None:
    """Partitioned Parquet write. ``mode="overwrite"`` replaces the table;
    with ``dynamic_overwrite`` only the partitions present in ``df`` are replaced.
    ``rebalance`` gathers each partition's rows first (one shuffle; large partitions are split),
    so that not every task writes a small file per partition."""
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).option("compression", compression)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.partitionBy(*partition_by).parquet(path)


def start_table_stream(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str],
                       available_now: bool = False, processing_time: str | None = None,
                       query_name: str | None = None) -> StreamingQuery:
    """Append-mode Parquet sink with a checkpoint (exactly-once file sink).
    Default trigger = back-to-back micro-batches; ``available_now`` processes what exists
    and stops (used by reruns and tests)."""
    w = (df.writeStream.outputMode("append").format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint)
         .partitionBy(*partition_by))
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def write_topic(routed: DataFrame, bootstrap: str, checkpoint: str | None = None) -> StreamingQuery | None:
    """Keyed topic sink for ``route_messages`` output (``topic``, ``key``, ``value``).
    Batch DataFrames are written at once; streaming ones return the started query."""
    out = routed.selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
    if out.isStreaming and not checkpoint:
        raise ValueError("a streaming topic sink needs a checkpoint folder")
    if out.isStreaming:
        return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
                .option("checkpointLocation", checkpoint).start())
    out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).save()
    return None
