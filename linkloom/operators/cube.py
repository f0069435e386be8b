"""Counts of distinct patents by entity or country and year, which add up over years.

A patent has one year, so a patent is counted in one cell of each entity and each country: distinct
patents of any range of years are plain sums of cells. Pages that ask for one range after the other,
and reports over all years, need neither links nor a distinct count.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkloom.operators import counting
from linkloom.sources import files
from linkloom.tables import Tables

# Cells of patents without a year, or that are not in the table of patents, have no year.
CUBE: dict[str, str] = {
    "inventor_years": "inventor_id string, patents bigint, year int",
    "company_years": "company_id string, patents bigint, year int",
    "country_years": "country string, patents bigint, year int",
    "country_links": "country string, links bigint",
    "patent_years": "year int, patents bigint",
    "totals": "inventor_links bigint",
}


def build(t: Tables) -> dict[str, DataFrame]:
    """The frames of :data:`CUBE`."""
    years = t.patents.select("patent_id", "year")
    people = t.patent_inventors.join(years, "patent_id", "left")
    firms = t.patent_companies.join(years, "patent_id", "left")
    homes = counting.homes(t.inventors)
    # The year belongs to the patent, so it splits no pair in two.
    cells = ["country", "year", "patent_id"]
    placed = files.spread(people.join(homes, "inventor_id").select(*cells), *cells).distinct()
    return {
        "inventor_years": _cells(t, people, "inventor_id"),
        "company_years": _cells(t, firms, "company_id"),
        "country_years": placed.groupBy("country", "year").agg(
            F.count("patent_id").alias("patents")).select("country", "patents", "year"),
        "country_links": counting.links_per_country(t.patent_inventors, t.inventors),
        "patent_years": t.patents.groupBy("year").agg(F.count("*").alias("patents")),
        "totals": t.patent_inventors.agg(F.count("*").alias("inventor_links")),
    }


def _cells(t: Tables, dated: DataFrame, key: str) -> DataFrame:
    count: Column = F.count("patent_id") if t.unique_links else F.countDistinct("patent_id")
    return dated.groupBy(key, "year").agg(count.alias("patents")).select(key, "patents", "year")


def write(t: Tables, folder: str) -> Tables:
    """Store the cube in ``folder``; the result answers from it. Cells lie by year, so that a range
    reads its years only."""
    for name, frame in build(t).items():
        writer = (frame.hint("rebalance", "year") if name.endswith("_years") else frame).write
        if name in ("inventor_years", "company_years", "country_years"):
            writer = writer.partitionBy("year").option("partitionOverwriteMode", "static")
        writer.mode("overwrite").parquet(f"{folder}/{name}")
    return attach(t, folder)


def is_stored(spark: SparkSession, folder: str) -> bool:
    """Whether :func:`write` came to its end; it writes the frames in the order of ``CUBE``."""
    return files.is_complete(spark, f"{folder}/{list(CUBE)[-1]}")


def stored(t: Tables, folder: str) -> Tables:
    """``t`` with the cube in ``folder``, which is written if it is not there."""
    there = is_stored(t.patents.sparkSession, folder)
    return attach(t, folder) if there else write(t, folder)


def attach(t: Tables, folder: str) -> Tables:
    """``t`` with the cube that :func:`write` stored for it."""
    spark = t.patents.sparkSession
    kinds = {"inventor_id": t.inventors, "company_id": t.companies}
    cube = {}
    for name, schema in CUBE.items():
        key = schema.split()[0]
        if key in kinds:
            # Ids are as the tables have them.
            schema = schema.replace("string", kinds[key].schema[key].dataType.simpleString(), 1)
        cube[name] = spark.read.schema(schema).parquet(f"{folder}/{name}")
    return replace(t, cube=cube)
