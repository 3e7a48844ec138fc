"""An index of the stored keys, so that a load does not read all keys ever stored.

Every load of a committed table (``sources.commits``) has, besides its data, its keys in ``buckets`` folders by key
hash (``_keys/load_id=<id>/bucket=<b>``) and a Bloom filter for each of them (``_blooms/load_id=<id>``). A new load
asks the filters of its keys' buckets, about 12 bits a stored key instead of the keys, and
opens only the key folders whose filter says that a key may be there; an exact anti-join decides. Nothing
depends on when a row arrives. Rows with a NULL key part have no key and are not looked up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from marketlake.sources import commits as C

#: Buckets of every load's keys; fixed for a table.
BUCKETS = 64
_PROBES, _BITS = 7, 12
#: Bytes of filters up to which they are broadcast.
BROADCAST_BYTES = 64 << 20


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*(F.col(k).cast("string") for k in keys))


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    has = reduce(and_, (F.col(k).isNotNull() for k in keys))
    return df.where(has).select(*keys, _hash(keys).alias("h")).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)))


def _place(h: Column, i: Column, words: Column) -> Column:
    """Bit of probe ``i`` among ``64 * words``."""
    high, low = F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))
    return (low + i * high.bitwiseOR(F.lit(1))) % (words * 64)


def write_index(spark: SparkSession, path: str, load: str, rows: int, schema: StructType, keys: Sequence[str]) -> None:
    """Write the keys and filters of a load that is written but not committed yet."""
    key_schema = StructType([schema[k] for k in keys])
    written = _keyed(spark.read.schema(key_schema).parquet(C.load_folder(path, load)), keys)
    written.repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/_keys/load_id={load}")
    words = max(1, -(-rows * _BITS // (64 * BUCKETS)))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, np.ndarray] = {}
        for batch in batches:
            buckets, h = (np.asarray(batch.column(i)) for i in (0, 1))
            low, high = h & 0xFFFFFFFF, (h.view(np.uint64) >> np.uint64(32)).astype(np.int64) | 1
            for b in np.unique(buckets):
                mine = buckets == b
                bits = filters.setdefault(int(b), np.zeros(64 * words, bool))
                for i in range(_PROBES):
                    bits[(low[mine] + i * high[mine]) % (64 * words)] = True
        if filters:
            packed = [np.packbits(bits, bitorder="little").view(np.int64) for bits in filters.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(filters), pa.int64()), pa.array(packed, pa.list_(pa.int64()))], names=["bucket", "bits"])

    blooms = written.select("bucket", "h").repartition("bucket").mapInArrow(fill, "bucket long, bits array<long>")
    blooms.write.mode("overwrite").parquet(f"{path}/_blooms/load_id={load}")


_BLOOMS = "bucket long, bits array<long>, load_id string"


def folders_to_open(incoming: DataFrame, path: str, state: C.State) -> list[tuple[str, int]]:
    """(load, bucket) of the key folders in which a key of ``incoming`` (with h and bucket) may be: at most one per
    load and bucket."""
    spark = incoming.sparkSession
    loads = [load for load, rows in state.loads.items() if rows]
    if not loads:
        return []
    blooms = spark.read.schema(_BLOOMS).option("basePath", f"{path}/_blooms").parquet(*(f"{path}/_blooms/load_id={load}" for load in loads))
    if sum(state.loads.values()) * _BITS // 8 <= BROADCAST_BYTES:
        blooms = F.broadcast(blooms)
    words = F.size("bits")
    may = F.forall(F.sequence(F.lit(0), F.lit(_PROBES - 1)), lambda i: F.getbit(
        F.get("bits", F.floor(_place(F.col("h"), i, words) / 64).cast("int")), (_place(F.col("h"), i, words) % 64).cast("int")) == 1)
    found = incoming.select("h", "bucket").join(blooms, "bucket").where(may).select("load_id", "bucket").distinct()
    return sorted((r.load_id, r.bucket) for r in found.collect())


def not_stored(df: DataFrame, path: str, state: C.State, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` (a written table: it is read twice) whose key no visible load holds."""
    spark = df.sparkSession
    folders = folders_to_open(_keyed(df, keys), path, state)
    if not folders:
        return df
    schema = StructType([*(df.schema[k] for k in keys), StructField("h", LongType()), StructField("bucket", LongType()), StructField("load_id", StringType())])
    stored = spark.read.schema(schema).option("basePath", f"{path}/_keys").parquet(*(f"{path}/_keys/load_id={load}/bucket={b}" for load, b in folders))
    return df.join(stored.select(*keys), list(keys), "left_anti")
