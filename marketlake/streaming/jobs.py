"""Structured Streaming jobs (A5-A7, H1-H4, D11 stream form, J1 stream form).

Bronze streams are stateless and map-only: the same ``bronze_*`` transforms as batch. The
silver stream reads bronze Parquet files as a file stream; its checkpoint replaces the
ingest high-water mark and makes reruns exactly-once. Row-framed gold windows are not
supported on streams (``NON_TIME_WINDOW_NOT_SUPPORTED_IN_STREAMING``), so gold stays batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marketlake import schemas as S
from marketlake.operators import routing as R
from marketlake.operators.bronze import bronze_ticker, bronze_trades
from marketlake.operators.silver import silver_ticker, silver_trades
from marketlake.plans.jobs import store_load
from marketlake.session import materialize, scratch_scope
from marketlake.sources import commits as C
from marketlake.sources.lake import start_table_stream


def start_bronze(raw_stream: DataFrame, kind: str, path: str, checkpoint: str, available_now: bool = False,
                 ingest_date: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """C11/C12 + A5/A6: raw topic stream -> bronze Parquet, partitioned by event_date (with J6
    by ingest_date first). ``processing_time``: interval between micro-batches (H3)."""
    fn = {"ticker": bronze_ticker, "trades": bronze_trades}[kind]
    parts = [*(["ingest_date"] if ingest_date else []), *S.BRONZE_PARTITIONS]
    return start_table_stream(fn(raw_stream, ingest_date=ingest_date), path, checkpoint, parts, available_now=available_now,
                              processing_time=processing_time, query_name=f"bronze_{kind}")


def start_routing(raw_stream: DataFrame, routed_path: str, dropped_path: str, checkpoint: str, available_now: bool = False,
                  processing_time: str | None = None, **routing) -> StreamingQuery:
    """B1-B9 with dead letters: each micro-batch is classified once, its messages go to the committed table
    ``routed_path`` (a folder per topic) and what is dropped, with its reason, to ``dropped_path``; both are written
    as they are read, without a shuffle, as a task has few topics and reasons. A replayed micro-batch changes neither table. ``routing``: ``topics``, ``products``, ``ingest_ts``, ``source``."""
    spark = raw_stream.sparkSession
    stream = stream_name(spark, checkpoint)
    choice = {k: routing[k] for k in ("topics", "products") if k in routing}
    stamps = {k: v for k, v in routing.items() if k != "products"}

    def store(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            messages = materialize(R.classified(batch, **choice), "classified")
            for rows, path, parts in ((R.routed(messages, **stamps), routed_path, ["topic"]), (R.dead_letters(messages), dropped_path, ["reason"])):
                if C.read_state(spark, path).batches.get(stream, -1) < batch_id:
                    load = C.new_load()
                    C.commit(spark, path, C.appended(load, C.write_load(rows, path, parts, load, rebalance=False), stream, batch_id))

    w = raw_stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).queryName("routing")
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def bronze_file_stream(spark: SparkSession, path: str, kind: str, max_files: int | None = None, max_bytes: str | None = None) -> DataFrame:
    """Bronze files as a stream; ``max_files`` or ``max_bytes`` bound a micro-batch, so a backlog
    is worked off in several."""
    reader = spark.readStream.schema({"ticker": S.BRONZE_TICKER, "trades": S.BRONZE_TRADES}[kind])
    for option, value in (("maxFilesPerTrigger", max_files), ("maxBytesPerTrigger", max_bytes)):
        if value is not None:
            reader = reader.option(option, str(value))
    return reader.parquet(path)


def start_silver(spark: SparkSession, bronze_path: str, kind: str, path: str, checkpoint: str, available_now: bool = True,
                 dedup: bool = False, processing_time: str | None = None, max_files: int | None = None,
                 max_bytes: str | None = None) -> StreamingQuery:
    """D11 stream form: bronze files -> silver Parquet (event_date, product_id) with a
    checkpoint: every bronze file is processed exactly once across reruns.

    ``dedup`` drops repeats: trades by (product_id, trade_id) (J1), ticker rows by (product_id,
    sequence_num) (J2; the ticker silver then keeps client_id and sequence_num). Each micro-batch
    is compared with itself and with all stored keys, so a row is dropped only if its key is
    stored, however late it comes (H4). Silver is then a committed table (read it with
    ``plans.jobs.read_lake``): a replayed micro-batch changes nothing, and a stream with a new
    checkpoint is another stream, which adds to what is stored and replaces none of it."""
    src = bronze_file_stream(spark, bronze_path, kind, max_files, max_bytes)
    out = silver_trades(src) if kind == "trades" else silver_ticker(src, keep_sequence=dedup)
    if not dedup:
        return start_table_stream(out, path, checkpoint, S.SILVER_PARTITIONS, available_now=available_now,
                                  processing_time=processing_time, query_name=f"silver_{kind}")

    stream = stream_name(spark, checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        store_load(batch.sparkSession, batch, kind, path, stream, batch_id)

    w = out.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).queryName(f"silver_{kind}")
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A name of its own for the stream of a checkpoint, kept in the checkpoint: batch numbers start
    again with each new one."""
    file = f"{checkpoint}/marketlake-stream.txt"
    C.put_if_absent(spark, file, uuid.uuid4().hex)
    return spark.read.text(file).first()["value"]


def await_query(query: StreamingQuery) -> None:
    """Block until the query ends; its error is raised here."""
    query.awaitTermination()


def run_until_idle(query: StreamingQuery, timeout_s: float | None = None) -> bool:
    """Block until the query ends or ``timeout_s`` passes; whether it has ended. A query that
    still runs is left running; the error of one that failed is raised."""
    if timeout_s is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(timeout_s))
