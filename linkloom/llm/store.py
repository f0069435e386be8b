"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.session import scratch_path, ship

__all__ = ["Store", "ship"]


class Store:
    """A new folder below ``spark.checkpoint.dir`` that holds the tables of one run."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = scratch_path(spark)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, name: str, frame: DataFrame, compression: str = "snappy") -> DataFrame:
        """Write ``frame`` and return the table. It survives the loss of any executor."""
        frame.write.mode("overwrite").parquet(self.path(name), compression=compression)
        return self.spark.read.schema(frame.schema).parquet(self.path(name))
