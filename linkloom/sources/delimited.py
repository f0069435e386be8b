"""Delimited text: raw files in, CSV files in and out."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.functions.text import missing_to_null
from linkloom.schemas import MODEL, RAW_FILES
from linkloom.sources.records import read_records
from linkloom.tables import Tables

ORDINAL = "_ordinal"


def read_delimited(
    spark: SparkSession, path: str, wanted: Iterable[str], sep: str = "\t"
) -> DataFrame:
    """All files under ``path`` as text columns, plus ``_ordinal``, their place.

    Only those of ``wanted`` that the header has are read. Texts that stand for a missing
    value become null, but for ``country``, where ``NA`` is a country. Part files must share
    one header; a differing one raises. ``_ordinal`` sorts rows by file, then by place.

    Quoted fields may hold line breaks; large files are read by many tasks all the same (see
    :mod:`linkloom.sources.records`, which reads the files once beforehand). Rows are those of
    Spark's own reader with ``multiLine``, which reads a file by one task.
    """
    options = {"sep": sep, "quote": '"', "escape": '"'}
    names = spark.read.options(**options, header=True, multiLine=True).csv(path).columns
    fields = ", ".join(f"_{i} string" for i in range(len(names)))
    records = read_records(spark, path, sep).where("record <> ''")
    heading = F.from_csv(F.regexp_replace("record", "^\ufeff", ""), fields, options)
    said = F.transform(F.array(*[heading[f"_{i}"] for i in range(len(names))]),
                       lambda x: F.lower(F.coalesce(x, F.lit(""))))
    # Repeated and empty names are numbered in `names`.
    bare = [re.sub(f"^_c{i}$|(?<=.){i}$", "", n.lower()) for i, n in enumerate(names)]
    same = F.forall(
        F.arrays_zip(said.alias("a"), F.array(*map(F.lit, bare)).alias("b"),
                     F.array(*[F.lit(n.lower()) for n in names]).alias("c")),
        lambda x: (x["a"] == x["b"]) | (x["a"] == x["c"]),
    )
    other = F.raise_error(F.concat(F.lit("a part file has another header: "), F.col("record")))
    rows = records.where(
        F.when(~F.col("head"), True).when(same, False).otherwise(other.cast("boolean"))
    ).select(F.from_csv("record", fields, options).alias("_fields"), F.col("place").alias(ORDINAL))
    columns = [F.col(f"_fields._{names.index(c)}").alias(c) for c in wanted if c in names]
    return missing_to_null(rows.select(*columns, ORDINAL))


def read_raw(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    """One raw file of :data:`RAW_FILES`: ``name.tsv``, ``.tsv.gz``, ``.tsv.bz2`` or a
    folder of that name with part files."""
    path = f"{raw_dir}/{name}.tsv{{,.gz,.bz2}}"
    return read_delimited(spark, path, RAW_FILES[name])


def read_clean_csv(spark: SparkSession, clean_dir: str) -> Tables:
    """Clean CSV tables, typed; texts that do not fit a type become null.

    The files are those :func:`write_clean_csv` writes: ``clean_<table>.csv``.
    """
    frames = {}
    for table, schema in MODEL.items():
        path = f"{clean_dir}/{_csv_name(table)}"
        found = read_delimited(spark, path, schema.names, sep=",")
        frames[table] = found.select(
            *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
        )
    return Tables(**frames)


def write_clean_csv(tables: Tables, clean_dir: str) -> None:
    """One CSV folder per table; nulls and empty texts are written as nothing."""
    for table, frame in tables.items():
        write_csv(frame.select(*MODEL[table].names), f"{clean_dir}/{_csv_name(table)}")


def write_csv(frame: DataFrame, path: str, sep: str = ",", compression: str = "none") -> None:
    (
        frame.write.mode("overwrite").option("header", True).option("emptyValue", "")
        .option("sep", sep).option("quote", '"').option("escape", '"')
        .option("compression", compression).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _csv_name(table: str) -> str:
    # Fixed value: the company links are filed under their older name.
    return "clean_patent_assignees.csv" if table == "patent_companies" else f"clean_{table}.csv"
