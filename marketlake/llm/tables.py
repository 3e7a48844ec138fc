"""Reading inputs and writing intermediate tables to the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import shared_folder


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a variant of it, that is no column of ``df`` (case-insensitively)."""
    taken, name = {c.lower() for c in df.columns}, wanted
    while name.lower() in taken:
        name = "_" + name
    return name


class Scratch:
    """Tables written to the shared folder to cut lineage; each has a path of its own."""

    def __init__(self, spark: SparkSession, name: str, within: str | None = None):
        self.spark = spark
        self.root = f"{within or shared_folder(spark) + '/marketlake-llm'}/{name}-{uuid.uuid4().hex[:12]}"

    @contextmanager
    def part(self, name: str) -> Iterator[Scratch]:
        """A folder for tables that only serve to write others; it goes at the end of the block."""
        part = Scratch(self.spark, name, self.root)
        try:
            yield part
        finally:
            part.delete()

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back (schema known: no job to infer it)."""
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:6]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self) -> None:
        """Remove all tables; only after everything that reads them has run."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
