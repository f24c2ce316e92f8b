"""Intermediate tables in the folder that all executors share.

Operators that need their input twice write it once as Parquet and read it back, so a lost
executor costs its running tasks and nothing else. The tables lie in the application's folder below
``spark.checkpoint.dir``, which is removed at exit; what no later read needs is dropped before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketlens.llm.shipping import ship
from ticketlens.sources.shared import delete_folder, scratch_path


class Scratch:
    """Tables of one operator call, below one new folder."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.folder = scratch_path(spark, name)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Writes the rows and returns them as read back."""
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Removes a table that no later read needs."""
        delete_folder(self.spark, self.path(name))
