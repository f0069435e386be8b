"""Every query by name, bound to the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.functions import text
from linkloom.operators import bitmaps, cleaning, cube, quality
from linkloom.operators.dedup import kept
from linkloom.plans import queries as q
from linkloom.plans import reports as r
from linkloom.plans import trends as v
from linkloom.plans.cache import Pages, ResultCache
from linkloom.plans.job import run_job
from linkloom.schemas import MODEL, PRIMARY_KEYS, RAW_FILES
from linkloom.session import scratch_path
from linkloom.sources import files, star
from linkloom.sources.delimited import (
    ORDINAL, read_clean_csv, read_raw, write_clean_csv, write_csv,
)
from linkloom.sources.parquet import read_tables, write_table, write_tables
from linkloom.sources.snapshots import Snapshots
from linkloom.tables import Tables, run_sql

# The star schema holds years 1995 to 2001; the range cuts at both ends.
YEAR_FROM, YEAR_TO = 1996, 2000

Query = Callable[[SparkSession, str], DataFrame]


def _on_model(fn: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, sf_dir: fn(star.model_tables(spark, sf_dir), **params)


# A scratch folder for each application.
_SCRATCH: dict[str, str] = {}


def _kept(spark: SparkSession, sf_dir: str) -> tuple[Tables, str]:
    """The model tables at the version of their files, and the folder of what is kept for it."""
    root = _SCRATCH.setdefault(spark.sparkContext.applicationId, scratch_path(spark))
    version = files.version_of(spark, [f"{sf_dir}/{name}.parquet" for name in star.MODEL_SOURCES])
    return replace(star.model_tables(spark, sf_dir), version=version), f"{root}/{version}"


def page_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The model tables with a cube that is stored once for each version of their files, as the
    batch job stores it with the tables."""
    t, folder = _kept(spark, sf_dir)
    return cube.stored(t, f"{folder}/cube")


def _on_pages(fn: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, sf_dir: fn(page_tables(spark, sf_dir), **params)


def _in_range(fn: Callable[..., DataFrame], **params) -> Query:
    return _on_pages(fn, year_from=YEAR_FROM, year_to=YEAR_TO, **params)


def _cube(name: str) -> Query:
    return lambda spark, sf_dir: cube.build(star.model_tables(spark, sf_dir))[name]


def _cached_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page that is asked for twice; the second answer is read from the first."""
    t, folder = _kept(spark, sf_dir)
    pages = Pages(cube.stored(t, f"{folder}/cube"), ResultCache(spark, f"{folder}/results", t.version))
    for _ in range(2):
        page = pages.show("countries", year_from=YEAR_FROM, year_to=YEAR_TO)
    return page


def _bitmap_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct patents per country from links that arrive in two overlapping parts."""
    store, t = scratch_path(spark), star.model_tables(spark, sf_dir)
    part = F.pmod(F.xxhash64("patent_id", "inventor_id"), F.lit(4))
    for some in (part < 3, part > 0):
        bitmaps.add(store, t.patent_inventors.where(some), t.inventors)
    return bitmaps.country_counts(spark, store)


def _ids_as_text(frame: DataFrame) -> DataFrame:
    return frame.withColumns(
        {c: F.col(c).cast("string") for c in frame.columns if c.endswith("_id")})


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables are stored, and a second version of them is begun but never published."""
    store = scratch_path(spark)
    made = star.model_tables(spark, sf_dir)
    texts = {name: _ids_as_text(frame) for name, frame in made.items()}
    t = write_tables(replace(made, **texts), store)
    snapshots = Snapshots(spark, store)
    write_table(t.patents.where("year = 1996"), snapshots.folder(snapshots.begin()), "patents")
    return _iso(read_tables(spark, store).patents)


def _iso(df: DataFrame) -> DataFrame:
    return df.withColumn("filing_date", F.date_format("filing_date", "yyyy-MM-dd"))


def _patent_detail(t: Tables) -> DataFrame:
    return _iso(q.q5_patent_detail(t))


class Cleaned:
    """The five clean tables over the raw ones, and what was dropped."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.raw = star.raw_tables(spark, sf_dir)

    def stage(self, table: str) -> DataFrame:
        raw, keys = self.raw, self.keys
        if table == "patents":
            return cleaning.patents_stage(raw["g_patent"])
        if table == "inventors":
            return cleaning.inventors_stage(raw["g_inventor_disambiguated"])
        if table == "companies":
            return cleaning.companies_stage(raw["g_assignee_disambiguated"])
        if table == "patent_inventors":
            return cleaning.patent_inventors_stage(
                raw["g_patent_inventor"], keys("patents"), keys("inventors"))
        return cleaning.patent_companies_stage(
            raw["g_patent_assignee"], keys("patents"), keys("companies"))

    def keys(self, table: str) -> DataFrame:
        """The keys of a cleaned entity table. The hint puts a shuffle of its own above the
        aggregation, so that AQE may split a frequent key in the join that follows, as it may
        where the job joins written tables."""
        return kept(self.stage(table)).select(*PRIMARY_KEYS[table]).hint("rebalance")

    def clean(self, table: str) -> DataFrame:
        if table == "patent_inventors":
            return cleaning.clean_patent_inventors(
                self.raw["g_patent_inventor"], self.keys("patents"), self.keys("inventors"))
        if table == "patent_companies":
            return cleaning.clean_patent_companies(
                self.raw["g_patent_assignee"], self.keys("patents"), self.keys("companies"))
        return kept(self.stage(table))

    def drop_report(self) -> DataFrame:
        counts = [quality.stage_counts(self.stage(n), n) for n in MODEL]
        return quality.drop_report(reduce(DataFrame.unionByName, counts))

    def reject_report(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [quality.stage_rejects(self.stage(n), n) for n in MODEL])


def _clean(table: str) -> Query:
    return lambda spark, sf_dir: Cleaned(spark, sf_dir).clean(table)


def _clean_patents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(Cleaned(spark, sf_dir).clean("patents"))


def _job_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job stored about the rows it dropped."""
    work = scratch_path(spark)
    _run_job(spark, sf_dir, work)
    snapshots = Snapshots(spark, f"{work}/out/tables")
    folder = snapshots.folder(snapshots.current())
    return spark.read.schema(quality.REJECT_SCHEMA).parquet(f"{folder}/rejects")


def _job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the raw tables as files, run the whole job on them, return its drop report."""
    return _run_job(spark, sf_dir, scratch_path(spark), charts=True)


def _run_job(spark: SparkSession, sf_dir: str, work: str, **options) -> DataFrame:
    for name, frame in star.raw_tables(spark, sf_dir).items():
        columns = [c for c in RAW_FILES[name] if c in frame.columns]
        write_csv(frame.orderBy(ORDINAL).select(*columns), f"{work}/raw/{name}.tsv", sep="\t")
    return run_job(spark, f"{work}/raw", f"{work}/out", **options)


def _collapsed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = star.documents(spark, sf_dir)
    return documents.select("doc_id", text.collapse_spaces(F.col("text")).alias("text"))


def _raw_files(name: str, **options) -> Query:
    """Write a raw table, whose texts hold quotes, tabs and line breaks, and read it back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_path(spark)
        frame = star.raw_tables(spark, sf_dir)[name].drop(ORDINAL)
        write_csv(frame, f"{folder}/{name}.tsv", sep="\t", **options)
        return read_raw(spark, folder, name).drop(ORDINAL)

    return query


def _clean_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model tables as clean CSV files, twice, as a rerun replaces them, and read back."""
    folder = scratch_path(spark)
    for _ in range(2):
        write_clean_csv(star.model_tables(spark, sf_dir), folder)
    return _iso(read_clean_csv(spark, folder).patents)


def _sql_on_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    star.model_tables(spark, sf_dir).register_views()
    return run_sql(
        spark,
        """SELECT country, count(*) AS links FROM patent_inventors JOIN inventors USING (inventor_id)
           WHERE country <> :unknown GROUP BY country""",
        unknown="UNKNOWN",
    )


def _summary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark)
    r.write_reports(page_tables(spark, sf_dir), folder)
    return r.as_json(r.read_summary(spark, folder))


def _report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark)
    r.write_reports(page_tables(spark, sf_dir), folder)
    schema = "name string, country string, patents bigint"
    return spark.read.schema(schema).csv(f"{folder}/top_inventors.csv", header=True)


def _export_file(name: str, schema: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_path(spark)
        r.write_page_exports(page_tables(spark, sf_dir), folder, YEAR_FROM, YEAR_TO)
        return spark.read.schema(schema).csv(f"{folder}/{name}.csv", header=True)

    return query


def _integrity_flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.integrity(star.flawed_tables(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "q1_top_inventors": _on_model(q.q1_top_inventors),
    "q2_top_companies": _on_model(q.q2_top_companies),
    "q3_country_share": _on_model(q.q3_country_share),
    "q4_yearly_trend": _on_model(q.q4_yearly_trend),
    "q5_patent_detail": _on_model(_patent_detail),
    "q6_country_year_activity": _on_model(q.q6_country_year_activity),
    "q7_ranked_inventors": _on_model(q.q7_ranked_inventors),
    "r_total_patents": _on_model(r.r_total_patents),
    "r_top_inventors": _on_model(r.r_top_inventors),
    "r_top_companies": _on_model(r.r_top_companies),
    "r_countries": _on_model(r.r_countries),
    "r_yearly": _on_model(r.r_yearly),
    "r_ranked_inventors": _on_model(r.r_ranked_inventors),
    "r_summary": _on_model(lambda t: r.as_json(r.r_summary(t))),
    "v_top_inventors": _on_model(v.v_top_inventors),
    "v_top_companies": _on_model(v.v_top_companies),
    "v_country_share_other": _on_model(v.v_country_share_other),
    "v_country_share_rest": _on_model(v.v_country_share_other, pool=None),
    "v_top5_countries": _on_model(v.v_top5_countries),
    "v_country_trend": _on_model(v.v_country_trend_places),
    "v_country_trend_long": _on_model(v.v_country_trend_long),
    "d_overview_totals": _on_model(v.d_overview_totals),
    "d_yearly": _in_range(v.d_yearly),
    "d_top_inventors": _in_range(v.d_top_inventors),
    "d_top_companies": _in_range(v.d_top_companies),
    "d_countries": _in_range(v.d_countries),
    "d_yoy_growth": _in_range(v.d_yoy_growth),
    "d_country_trend": _in_range(v.d_country_trend_places),
    "d_country_trend_long": _in_range(v.d_country_trend_long),
    "d_cube_inventors": _cube("inventor_years"),
    "d_cube_companies": _cube("company_years"),
    "d_cube_countries": _cube("country_years"),
    "d_cached_countries": _cached_countries,
    "s_bitmap_countries": _bitmap_countries,
    "c_patents": _clean_patents,
    "c_inventors": _clean("inventors"),
    "c_companies": _clean("companies"),
    "c_patent_inventors": _clean("patent_inventors"),
    "c_patent_companies": _clean("patent_companies"),
    "c_drop_report": lambda spark, sf_dir: Cleaned(spark, sf_dir).drop_report(),
    "c_reject_report": lambda spark, sf_dir: Cleaned(spark, sf_dir).reject_report(),
    "c_integrity": _on_model(quality.integrity),
    "c_integrity_flawed": _integrity_flawed,
    "c_collapse_spaces": _collapsed_documents,
    "s_raw_patents": _raw_files("g_patent"),
    "s_raw_inventors_gzip": _raw_files("g_inventor_disambiguated", compression="gzip"),
    "s_raw_companies_bzip2": _raw_files("g_assignee_disambiguated", compression="bzip2"),
    "s_clean_csv": _clean_csv,
    "s_sql_on_views": _sql_on_views,
    "s_summary_file": _summary_file,
    "s_report_file": _report_file,
    "s_export_file": _export_file(
        "country_trends", "Rank int, country string, patents bigint, share_pct double"),
    "s_export_inventors": _export_file(
        "top_inventors", "Rank int, name string, country string, patents bigint"),
    "s_export_companies": _export_file(
        "top_companies", "Rank int, company string, country string, patents bigint"),
    "s_snapshot": _snapshot,
    "job_drop_report": _job,
    "job_rejects": _job_rejects,
}
