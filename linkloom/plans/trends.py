"""Datasets behind the charts and the interactive pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from linkloom.functions.text import percent
from linkloom.operators import counting, ranking
from linkloom.plans import queries as q
from linkloom.tables import Tables

# Fixed value: the range the interactive pages start with.
YEARS = (2015, 2023)


def v_top_inventors(t: Tables, k: int = 10) -> DataFrame:
    """name, patents of the top inventors, smallest first."""
    counts = counting.inventor_counts(t)
    best = ranking.top(counts, k, "patent_count", "inventor_id")
    return best.orderBy("patent_count", F.desc("inventor_id")).limit(k).select(
        "name", F.col("patent_count").alias("patents")
    )


def v_top_companies(t: Tables, k: int = 10) -> DataFrame:
    """company, patents of the top companies."""
    return q.q2_top_companies(t, k).select("company", F.col("patent_count").alias("patents"))


def v_country_share_other(t: Tables, keep: int = 7, pool: int | None = 8) -> DataFrame:
    """country, patents, pct of the top countries and a last row "Other".

    "Other" is what the ``pool`` largest countries have beyond the ``keep`` largest; with
    ``pool=None`` it is what all other countries have. The counts are used in one place
    only: AQE does not split skewed joins in a second use that starts from shuffles it has
    already run. The windows see a row per country, of which two letters give 676 at most.
    """
    counts = counting.country_counts(t)
    if pool is not None:
        counts = ranking.top(counts, pool, "patent_count", "country")
    counts = ranking.positions(counts, "patent_count", "country", "_place")
    kept = F.col("_place") <= keep
    # A row of its own makes "Other" appear even if nothing is left for it.
    nothing = counts.sparkSession.range(1).selectExpr("CAST(NULL AS STRING) AS country", "0L AS n")
    slices = (
        counts.select(F.when(kept, F.col("country")).alias("country"), F.col("patent_count").alias("n"))
        .unionByName(nothing)
        .groupBy("country").agg(F.sum("n").alias("patents"))
    )
    whole = F.sum("patents").over(Window.partitionBy())
    return (
        slices.withColumn("pct", percent(F.col("patents"), whole, 1))
        .orderBy(F.col("country").isNull(), F.desc("patents"), "country")
        .limit(keep + 1)
        .withColumn("country", F.coalesce("country", F.lit("Other")))
    )


def v_top5_countries(t: Tables, k: int = 5) -> DataFrame:
    """country, for the countries with most inventor links."""
    counts = (
        t.cube["country_links"] if t.cube
        else counting.links_per_country(t.patent_inventors, t.inventors)
    )
    return ranking.top(counts, k, "links", "country").select("country")


def v_trend_countries(t: Tables, k: int = 5) -> DataFrame:
    """place, country: the top countries by the alphabet, from place 1."""
    place = F.row_number().over(Window.orderBy("country"))
    return v_top5_countries(t, k).select(place.alias("place"), "country")


def v_country_trend_places(
    t: Tables, k: int = 5, year_from: int | None = None, year_to: int | None = None
) -> DataFrame:
    """year and ``country_1`` to ``country_k``: the patents of that year of the countries of
    :func:`v_trend_countries`, 0 if none, also where there are fewer countries.

    One lazy plan: the countries' names stay data, their places are what is aggregated by.
    """
    places = v_trend_countries(t, k)
    if t.cube:
        cells = counting.in_years(t.cube["country_years"], year_from, year_to)
        return _by_place(cells.join(places, "country"), k, lambda here: F.sum(here("patents")))
    lands = t.inventors.join(places, "country").select("inventor_id", "place").hint("rebalance")
    # One flag per place replaces the distinct count: a single aggregation by patent.
    per_patent = t.patent_inventors.join(lands, "inventor_id").groupBy("patent_id").agg(
        *[F.max(F.col("place") == i).alias(f"_in{i}") for i in range(1, k + 1)]
    )
    years = counting.in_years(t.patents, year_from, year_to).select("patent_id", "year")
    return per_patent.join(years, "patent_id").groupBy("year").agg(
        *[F.count_if(f"_in{i}").alias(f"country_{i}") for i in range(1, k + 1)]
    ).orderBy("year")


def _by_place(cells: DataFrame, k: int, total) -> DataFrame:
    def at(i: int):
        return lambda column: F.when(F.col("place") == i, F.col(column)).otherwise(0)

    return cells.groupBy("year").agg(
        *[total(at(i)).alias(f"country_{i}") for i in range(1, k + 1)]
    ).orderBy("year")


def v_country_trend(
    t: Tables, k: int = 5, year_from: int | None = None, year_to: int | None = None
) -> DataFrame:
    """:func:`v_country_trend_places` with the countries' names for column names, as a file with
    a header needs them; the ``k`` names are fetched for that."""
    names = [r["country"] for r in v_trend_countries(t, k).orderBy("place").collect()]
    wide = v_country_trend_places(t, k, year_from, year_to)
    return wide.select(
        "year", *[F.col(f"country_{i}").alias(n) for i, n in enumerate(names, 1)]
    )


def v_country_trend_long(
    t: Tables, k: int = 5, year_from: int | None = None, year_to: int | None = None
) -> DataFrame:
    """year, country, patents: the cells of :func:`v_country_trend` that are not 0.

    One lazy plan; the countries stay in it as a semi-join.
    """
    best = v_top5_countries(t, k)
    if t.cube:
        cells = counting.in_years(t.cube["country_years"], year_from, year_to)
        return cells.join(best, "country", "left_semi").select("year", "country", "patents")
    lands = t.inventors.join(best, "country", "left_semi").select("inventor_id", "country")
    pairs = (
        t.patent_inventors.join(lands.hint("rebalance"), "inventor_id")
        .select("patent_id", "country").distinct()
    )
    years = counting.in_years(t.patents, year_from, year_to).select("patent_id", "year")
    return pairs.join(years, "patent_id").groupBy("year", "country").agg(
        F.count("*").alias("patents")
    )


def d_overview_totals(t: Tables) -> DataFrame:
    """patents, inventors, companies, countries: sizes of the whole collection."""
    country = F.when(counting.known(F.col("country")), F.col("country"))
    people = t.inventors.agg(
        F.count("*").alias("inventors"), F.countDistinct(country).alias("countries")
    )
    return people.select(
        t.patents.agg(F.count("*")).scalar().alias("patents"),
        "inventors",
        t.companies.agg(F.count("*")).scalar().alias("companies"),
        "countries",
    )


def d_yearly(t: Tables, year_from: int = YEARS[0], year_to: int = YEARS[1]) -> DataFrame:
    """year, patents in order of year."""
    return (
        q.yearly_counts(t, year_from, year_to)
        .withColumnRenamed("patent_count", "patents").orderBy("year")
    )


def d_top_inventors(
    t: Tables, year_from: int = YEARS[0], year_to: int = YEARS[1], top_n: int = 20
) -> DataFrame:
    """Rank, name, country, patents by patents filed in the range."""
    return _numbered(counting.inventor_counts(t, year_from, year_to), top_n, "name")


def d_top_companies(
    t: Tables, year_from: int = YEARS[0], year_to: int = YEARS[1], top_n: int = 15
) -> DataFrame:
    """Rank, company, country, patents by patents filed in the range."""
    return _numbered(counting.company_counts(t, year_from, year_to), top_n, "company")


def _numbered(counts: DataFrame, n: int, name: str) -> DataFrame:
    key = counts.columns[0]
    best = ranking.top(counts, n, "patent_count", key)
    return ranking.positions(best, "patent_count", key, "Rank").select(
        "Rank", F.col("name").alias(name), "country", F.col("patent_count").alias("patents")
    )


def d_countries(
    t: Tables, year_from: int = YEARS[0], year_to: int = YEARS[1], k: int = 20
) -> DataFrame:
    """Rank, country, patents, share_pct by patents filed in the range.

    The share is of all inventor links, those of other years included.
    """
    counts = counting.country_counts(t, year_from, year_to)
    best = ranking.top(counts, k, "patent_count", "country")
    ranked = ranking.positions(best, "patent_count", "country", "Rank")
    return counting.with_share(ranked, t).withColumnRenamed(
        "patent_count", "patents"
    )


def d_yoy_growth(t: Tables, year_from: int = YEARS[0], year_to: int = YEARS[1]) -> DataFrame:
    """year, patents, yoy_growth: percent over the previous year that has patents."""
    before = F.lag("patents").over(Window.orderBy("year"))
    growth = (F.col("patents").cast("double") / before - 1) * 100
    return d_yearly(t, year_from, year_to).withColumn("yoy_growth", growth).orderBy("year")


def d_country_trend(
    t: Tables, year_from: int = YEARS[0], year_to: int = YEARS[1], k: int = 5
) -> DataFrame:
    """:func:`v_country_trend` for a range; the countries are still those of all years."""
    return v_country_trend(t, k, year_from, year_to)


def d_country_trend_places(
    t: Tables, year_from: int = YEARS[0], year_to: int = YEARS[1], k: int = 5
) -> DataFrame:
    return v_country_trend_places(t, k, year_from, year_to)


def d_country_trend_long(
    t: Tables, year_from: int = YEARS[0], year_to: int = YEARS[1], k: int = 5
) -> DataFrame:
    return v_country_trend_long(t, k, year_from, year_to)
