"""The seven documented queries on the model tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkloom.functions.text import percent
from linkloom.operators import counting, ranking
from linkloom.tables import Tables

def q1_top_inventors(t: Tables, k: int = 20) -> DataFrame:
    """name, country, patent_count of the inventors with most patents."""
    counts = counting.inventor_counts(t)
    best = ranking.top(counts, k, "patent_count", "inventor_id")
    return best.select("name", "country", "patent_count")


def q2_top_companies(t: Tables, k: int = 20) -> DataFrame:
    """company, country, patent_count of the companies with most patents."""
    counts = counting.company_counts(t)
    best = ranking.top(counts, k, "patent_count", "company_id")
    return best.select(F.col("name").alias("company"), "country", "patent_count")


def q3_country_share(t: Tables, k: int = 20) -> DataFrame:
    """country, patent_count, share_pct of the countries with most patents.

    The share is of all inventor links, unknown countries included, not of all patents.
    """
    counts = counting.country_counts(t)
    best = ranking.top(counts, k, "patent_count", "country")
    return counting.with_share(best, t)


def q4_yearly_trend(t: Tables) -> DataFrame:
    """year, patent_count in order of year."""
    return yearly_counts(t).orderBy("year")


def yearly_counts(
    t: Tables, year_from: int | None = None, year_to: int | None = None
) -> DataFrame:
    """year, patent_count of a range of years."""
    if t.cube:
        cells = counting.in_years(t.cube["patent_years"], year_from, year_to)
        return cells.select("year", F.col("patents").alias("patent_count"))
    picked = counting.in_years(t.patents, year_from, year_to)
    return picked.groupBy("year").agg(F.count("*").alias("patent_count"))


def q5_patent_detail(t: Tables, k: int = 500) -> DataFrame:
    """The newest patents with every combination of their inventors and companies.

    Each patent gives at least one row, so ``k`` rows come from the first ``k`` patents,
    and from no more than the first ``k`` inventors and companies of each. Only those are
    joined. The plan is the same for every ``k``; AQE broadcasts what turns out to be small.
    """
    newest = [F.desc("year"), F.asc("patent_id")]
    patents = (
        t.patents.select("patent_id", "title", "filing_date", "year").orderBy(*newest).limit(k)
    )
    inventors = _first_partners(patents, t.patent_inventors, t.inventors, k)
    companies = _first_partners(patents, t.patent_companies, t.companies, k)
    return (
        patents.join(inventors, "patent_id", "left")
        .join(companies, "patent_id", "left")
        .orderBy(*newest, F.asc_nulls_first("inventor_id"), F.asc_nulls_first("company_id"))
        .limit(k)
        .select(
            "patent_id", "title", "filing_date", "year",
            "inventor_name", "inventor_country", "company_name",
        )
    )


def _first_partners(
    patents: DataFrame, links: DataFrame, entities: DataFrame, k: int
) -> DataFrame:
    """Up to ``k`` links of each of ``k`` patents, with names where the entity exists."""
    key = entities.columns[0]
    kind = key.removesuffix("_id")
    ids = patents.select("patent_id")
    own = links.join(ids, "patent_id", "left_semi")
    first = ranking.first_per_group(own, "patent_id", key, k)
    named = entities.join(first.select(key), key, "left_semi").select(
        key,
        F.col("name").alias(f"{kind}_name"),
        F.col("country").alias(f"{kind}_country"),
    )
    return first.join(named, key, "left")


def q6_country_year_activity(t: Tables, k: int = 100) -> DataFrame:
    """country, year, active_inventors, total_patents, patents_per_inventor.

    ``total_patents`` counts links: a patent with two inventors of a country counts twice.
    Links are first counted per inventor and year, which makes the distinct count of
    inventors a plain one and leaves few rows per inventor to join.
    """
    years = counting.in_years(t.patents, None, None).select("patent_id", "year")
    homes = t.inventors.where(counting.known(F.col("country"))).select("inventor_id", "country")
    activity = (
        t.patent_inventors.join(years, "patent_id")
        .groupBy("inventor_id", "year").agg(F.count("*").alias("links"))
        .join(homes, "inventor_id")
        .groupBy("country", "year")
        .agg(F.count("*").alias("active_inventors"), F.sum("links").alias("total_patents"))
    )
    ratio = F.col("total_patents").cast("double") / F.col("active_inventors")
    return (
        activity.withColumn("patents_per_inventor", F.round(ratio, 2))
        .orderBy(F.desc("year"), F.desc("total_patents"), F.asc("country"))
        .limit(k)
    )


def q7_ranked_inventors(t: Tables, k: int = 50) -> DataFrame:
    """global_rank, country_rank, name, country, patent_count, pct_of_total.

    Only the top ``k`` are ranked; the total is an aggregate of its own over the same
    counts, whose shuffle Spark runs once.
    """
    counts = counting.inventor_counts(t)
    whole = counts.agg(F.sum("patent_count")).scalar()
    best = ranking.top(counts, k, "patent_count", "inventor_id")
    return (
        best.select(
            ranking.competition_rank("patent_count").alias("global_rank"),
            ranking.group_rank("patent_count", "country").alias("country_rank"),
            "inventor_id", "name", "country", "patent_count",
        )
        .withColumn("pct_of_total", percent(F.col("patent_count"), whole, 4))
        .orderBy("global_rank", "inventor_id")
        .limit(k)
        .drop("inventor_id")
    )
