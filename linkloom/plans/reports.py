"""Report datasets, the nested summary, and the files they are written to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkloom.operators import counting, ranking
from linkloom.plans import queries as q
from linkloom.plans import trends
from linkloom.sources.delimited import write_csv
from linkloom.tables import Tables

# Fixed value: the shape of the summary file.
SUMMARY_SCHEMA = """
    total_patents bigint,
    top_inventors array<struct<rank: int, name: string, country: string, patents: bigint>>,
    top_companies array<struct<rank: int, company: string, country: string, patents: bigint>>,
    top_countries array<struct<rank: int, country: string, patents: bigint, share_pct: double>>,
    yearly_trends array<struct<year: int, patents: bigint>>
"""


def _as_patents(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("patent_count", "patents")


def r_total_patents(t: Tables) -> DataFrame:
    return t.patents.agg(F.count("*").alias("n"))


def r_top_inventors(t: Tables, k: int = 20) -> DataFrame:
    return _as_patents(q.q1_top_inventors(t, k))


def r_top_companies(t: Tables, k: int = 20) -> DataFrame:
    return _as_patents(q.q2_top_companies(t, k))


def r_countries(t: Tables, k: int = 20) -> DataFrame:
    return _as_patents(q.q3_country_share(t, k))


def r_yearly(t: Tables) -> DataFrame:
    return _as_patents(q.q4_yearly_trend(t))


def r_ranked_inventors(t: Tables, k: int = 50) -> DataFrame:
    """rank, name, country, patent_count, pct_of_total."""
    return q.q7_ranked_inventors(t, k).drop("country_rank").withColumnRenamed(
        "global_rank", "rank"
    )


def r_summary(t: Tables, k: int = 10) -> DataFrame:
    """One row: the total, three lists of the top ``k``, and all years."""
    people = counting.inventor_counts(t)
    firms = counting.company_counts(t).withColumnRenamed("name", "company")
    countries = q.q3_country_share(t, k)
    sections = {
        "top_inventors": _ranked(people, k, "inventor_id", "name", "country", "patents"),
        "top_companies": _ranked(firms, k, "company_id", "company", "country", "patents"),
        "top_countries": _ranked(countries, k, "country", "country", "patents", "share_pct"),
        "yearly_trends": _listed(r_yearly(t), "year", "patents"),
    }
    return r_total_patents(t).select(
        F.col("n").alias("total_patents"),
        *[section.alias(name) for name, section in sections.items()],
    )


def as_json(summary: DataFrame) -> DataFrame:
    """The summary as one JSON text."""
    return summary.select(F.to_json(F.struct("*")).alias("summary"))


def _ranked(counts: DataFrame, k: int, key: str, *fields: str) -> Column:
    best = ranking.top(counts, k, "patent_count", key)
    numbered = _as_patents(ranking.positions(best, "patent_count", key, "rank"))
    return _listed(numbered, "rank", *fields)


def _listed(rows: DataFrame, *fields: str) -> Column:
    """A short frame as one array of structs, sorted by its first field."""
    return rows.agg(F.sort_array(F.collect_list(F.struct(*fields)))).scalar()


def write_report(frame: DataFrame, path: str, sort: str | None = None) -> None:
    """A short frame as one CSV file. Frames that end in a limit are one ordered partition
    already, others need ``sort``."""
    one = frame.repartition(1).sortWithinPartitions(sort) if sort else frame.coalesce(1)
    write_csv(one, path)


def write_reports(t: Tables, report_dir: str) -> None:
    """Five CSV reports and the JSON summary."""
    write_report(r_top_inventors(t), f"{report_dir}/top_inventors.csv")
    write_report(r_top_companies(t), f"{report_dir}/top_companies.csv")
    write_report(r_countries(t), f"{report_dir}/country_trends.csv")
    write_report(r_yearly(t), f"{report_dir}/yearly_trends.csv", sort="year")
    write_report(r_ranked_inventors(t), f"{report_dir}/ranked_inventors.csv")
    r_summary(t).write.mode("overwrite").json(f"{report_dir}/summary_report.json")


def read_summary(spark: SparkSession, report_dir: str) -> DataFrame:
    return spark.read.schema(SUMMARY_SCHEMA).json(
        f"{report_dir}/summary_report.json", multiLine=True
    )


def write_chart_data(t: Tables, chart_dir: str) -> None:
    """The data of the five charts, one CSV each."""
    write_report(r_yearly(t), f"{chart_dir}/chart_yearly_trend.csv", sort="year")
    write_report(trends.v_top_inventors(t), f"{chart_dir}/chart_top_inventors.csv")
    write_report(trends.v_top_companies(t), f"{chart_dir}/chart_top_companies.csv")
    write_report(trends.v_country_share_other(t), f"{chart_dir}/chart_country_share.csv")
    write_report(trends.v_country_trend(t), f"{chart_dir}/chart_country_trend.csv", sort="year")


def write_page_exports(
    t: Tables, export_dir: str, year_from: int, year_to: int, inventors: int = 20,
    companies: int = 15,
) -> None:
    """The three tables the interactive pages offer for download."""
    picked = {
        "top_inventors": trends.d_top_inventors(t, year_from, year_to, inventors),
        "top_companies": trends.d_top_companies(t, year_from, year_to, companies),
        "country_trends": trends.d_countries(t, year_from, year_to),
    }
    for name, frame in picked.items():
        write_report(frame, f"{export_dir}/{name}.csv")
