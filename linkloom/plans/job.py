"""The batch job: raw files to clean tables, checks and reports, in one application."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession

from linkloom.operators import cleaning, cube
from linkloom.operators.quality import (
    count_columns, counts_frame, drop_report, reject_columns, rejects_frame, require_integrity,
)
from linkloom.plans.cache import ResultCache
from linkloom.plans.reports import write_chart_data, write_reports
from linkloom.session import build_session
from linkloom.sources.delimited import read_raw, write_clean_csv
from linkloom.sources.parquet import by_year, read_table, read_version, write_table
from linkloom.sources.snapshots import Snapshots


def run_job(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    csv: bool = True,
    charts: bool = False,
    literal_nulls: bool = False,
) -> DataFrame:
    """Rebuild everything under ``out_dir`` from ``raw_dir`` and return the drop report.

    Each table is written before the next step reads it, so a lost executor never causes
    more than one step to be repeated. The tables become visible all at once, when they are
    complete and checked; a job that dies before leaves the tables of the last one. CSV files
    and reports are written after that.
    """
    snapshots = Snapshots(spark, f"{out_dir}/tables")
    version = snapshots.begin()
    store = snapshots.folder(version)
    counts, rejects = [], []

    def store_stage(table: str, stage: DataFrame) -> None:
        # The counts ride with the rows into the writing stage. Spark counts the tasks of
        # that stage once each, even if lost executors make it repeat earlier ones.
        if table == "patents":
            stage = by_year(stage)
        seen, dropped = Observation(f"clean {table}"), Observation(f"rejects of {table}")
        watched = stage.observe(seen, *count_columns()).observe(dropped, *reject_columns(table))
        write_table(watched.where("_valid"), store, table)
        counts.append((table, seen.get["before"], seen.get["after"]))
        rejects.extend((table, reason, n) for reason, n in dropped.get.items())

    def raw(name: str) -> DataFrame:
        return read_raw(spark, raw_dir, name)

    store_stage("patents", cleaning.patents_stage(raw("g_patent")))
    store_stage("inventors", cleaning.inventors_stage(
        raw("g_inventor_disambiguated"), literal_nulls=literal_nulls))
    store_stage("companies", cleaning.companies_stage(
        raw("g_assignee_disambiguated"), literal_nulls=literal_nulls))
    patents, inventors, companies = (
        read_table(spark, store, n) for n in ("patents", "inventors", "companies")
    )
    store_stage("patent_inventors", cleaning.clean_patent_inventors(
        raw("g_patent_inventor"), patents, inventors, True))
    store_stage("patent_companies", cleaning.clean_patent_companies(
        raw("g_patent_assignee"), patents, companies, True))

    tables = read_version(spark, store, unique_links=True, version=version)
    require_integrity(tables)
    rejects_frame(spark, rejects).coalesce(1).write.parquet(f"{store}/rejects")
    tables = cube.write(tables, f"{store}/cube")
    snapshots.publish(version)
    snapshots.drop_old()
    ResultCache(spark, f"{snapshots.store}/results", version).drop_others()
    if csv:
        write_clean_csv(tables, f"{out_dir}/clean")
    write_reports(tables, f"{out_dir}/reports")
    if charts:
        write_chart_data(tables, f"{out_dir}/reports/charts")
    return drop_report(counts_frame(spark, counts))


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw_dir", help="folder of the raw .tsv files, any Hadoop path")
    parser.add_argument("out_dir", help="folder for tables, CSV files and reports")
    parser.add_argument("--charts", action="store_true", help="also write the chart data")
    parser.add_argument("--no-csv", action="store_true", help="skip the CSV copy of the tables")
    parser.add_argument("--literal-nulls", action="store_true", help="label nulls as UN")
    parser.add_argument("--partitions", type=int, help="of each shuffle, before small ones merge")
    parser.add_argument("--local", type=int, metavar="CORES", help="run on this machine")
    args = parser.parse_args()
    spark = build_session(local_cores=args.local, partitions=args.partitions)
    run_job(
        spark, args.raw_dir, args.out_dir, csv=not args.no_csv, charts=args.charts,
        literal_nulls=args.literal_nulls,
    ).show()


if __name__ == "__main__":
    main()
