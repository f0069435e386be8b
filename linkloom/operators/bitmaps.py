"""Exact distinct patents per country, kept as bitmaps to which later links can be added.

Patents get numbers; a bitmap has a bit for each of 32,768 numbers, so a country is as many rows as its
patents need and a frequent country is spread over tasks by bucket. Each task folds its links to bitmaps
before the shuffle. Bitmaps of the same country and bucket from several runs are joined by OR: a patent
that a country already has, by another inventor or in a link given twice, is not counted again. Counts
need the bits alone.

    store/versions/<version>/numbers     patents first met in that run: patent_id, number
    store/versions/<version>/bitmaps     country, bucket, bitmap of all runs so far
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.operators import counting
from linkloom.sources.snapshots import Snapshots

_BITMAPS = "country string, bucket bigint, bitmap binary"


def _numbers(spark: SparkSession, snapshots: Snapshots, versions: list[str], schema: str) -> DataFrame:
    parts = [spark.read.schema(schema).parquet(f"{snapshots.folder(v)}/numbers") for v in versions]
    return reduce(DataFrame.unionByName, parts)


def add(store: str, links: DataFrame, inventors: DataFrame) -> None:
    """Add the patents of ``links`` to the bitmaps in ``store``, which is begun if it is empty.

    Links without a patent, or to inventors that are unknown or of no known country, count for no
    country. A run that dies leaves the bitmaps as they were.
    """
    spark = links.sparkSession
    snapshots = Snapshots(spark, store)
    done, version = snapshots.published(), snapshots.begin()
    kind = links.schema["patent_id"].dataType.simpleString()
    schema, folder = f"patent_id {kind}, number bigint", snapshots.folder(version)
    whole = links.where(F.col("patent_id").isNotNull())
    ids, first = whole.select("patent_id").distinct(), 0
    if done:
        known = _numbers(spark, snapshots, done, schema)
        first = known.agg(F.coalesce(F.max("number"), F.lit(-1))).first()[0] + 1
        ids = ids.join(known, "patent_id", "left_anti")
    # Numbers are close together within a task, so that buckets are full; gaps between tasks cost nothing.
    ids.select("patent_id", (F.lit(first) + F.monotonically_increasing_id()).alias("number")) \
        .write.parquet(f"{folder}/numbers")
    numbers = _numbers(spark, snapshots, [*done, version], schema)
    placed = whole.join(counting.homes(inventors), "inventor_id").join(numbers, "patent_id")
    made = placed.groupBy("country", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )
    if done:
        before = spark.read.schema(_BITMAPS).parquet(f"{snapshots.folder(done[-1])}/bitmaps")
        made = made.unionByName(before).groupBy("country", "bucket").agg(
            F.bitmap_or_agg("bitmap").alias("bitmap"))
    made.write.parquet(f"{folder}/bitmaps")
    snapshots.publish(version)


def country_counts(spark: SparkSession, store: str) -> DataFrame:
    """country, patent_count over all links added so far."""
    snapshots = Snapshots(spark, store)
    version = snapshots.current()
    if version is None:
        return spark.createDataFrame([], "country string, patent_count bigint")
    bitmaps = spark.read.schema(_BITMAPS).parquet(f"{snapshots.folder(version)}/bitmaps")
    return bitmaps.groupBy("country").agg(F.sum(F.bitmap_count("bitmap")).alias("patent_count"))
