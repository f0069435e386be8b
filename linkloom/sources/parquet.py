"""The stored form of the model: one Parquet folder per table, in versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.operators import cube
from linkloom.schemas import MODEL
from linkloom.sources.snapshots import Snapshots
from linkloom.tables import Tables


def write_table(frame: DataFrame, store: str, table: str) -> None:
    """Replace one table. Patents are laid out by year for partition pruning."""
    writer = frame.select(*MODEL[table].names).write.mode("overwrite")
    if table == "patents":
        # Static, so that years of an earlier run do not stay behind.
        writer = writer.partitionBy("year").option("partitionOverwriteMode", "static")
    writer.parquet(f"{store}/{table}")


def by_year(patents: DataFrame) -> DataFrame:
    """Gather the rows of a year before writing, so that a year gets few, large files.

    AQE splits a year too large for one task and merges small ones.
    """
    return patents.hint("rebalance", "year")


def write_tables(tables: Tables, store: str) -> Tables:
    """Store all tables as a new version of ``store`` and make it the current one."""
    spark = tables.patents.sparkSession
    snapshots = Snapshots(spark, store)
    version = snapshots.begin()
    for table, frame in tables.items():
        write_table(by_year(frame) if table == "patents" else frame, snapshots.folder(version), table)
    snapshots.publish(version)
    return read_tables(spark, store, tables.unique_links)


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    schema = MODEL[table]
    return spark.read.schema(schema).parquet(f"{folder}/{table}").select(*schema.names)


def read_version(
    spark: SparkSession, folder: str, unique_links: bool = False, version: str | None = None
) -> Tables:
    """The tables in ``folder``, with their cube if it is there."""
    t = Tables(
        **{table: read_table(spark, folder, table) for table in MODEL},
        unique_links=unique_links, version=version,
    )
    return cube.attach(t, f"{folder}/cube") if cube.is_stored(spark, f"{folder}/cube") else t


def read_tables(spark: SparkSession, store: str, unique_links: bool = False) -> Tables:
    """The current version of the stored tables. Say ``unique_links=True`` for those the batch job
    wrote; their counts then need no shuffle of the links."""
    snapshots = Snapshots(spark, store)
    version = snapshots.current()
    folder = snapshots.folder(version) if version else store
    return read_version(spark, folder, unique_links, version)
