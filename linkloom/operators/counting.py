"""Counts over the link tables, grouped before they are joined.

Links are the largest tables and one entity may own a large part of them. Wherever the
result allows, links are therefore aggregated by entity first; the join then sees one row
per entity. Where single links must be joined, the result is shuffled anew afterwards,
which leaves AQE free to split a skewed partition of the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from linkloom.functions.text import percent
from linkloom.schemas import UNKNOWN
from linkloom.tables import Tables


def known(country: Column) -> Column:
    return country != UNKNOWN


def in_years(patents: DataFrame, year_from: int | None, year_to: int | None) -> DataFrame:
    """Patents with a year, both ends of the range inclusive; ``None`` leaves an end open."""
    picked = patents.where(F.col("year").isNotNull())
    if year_from is not None:
        picked = picked.where(F.col("year") >= year_from)
    if year_to is not None:
        picked = picked.where(F.col("year") <= year_to)
    return picked


def filed_in(links: DataFrame, t: Tables, year_from: int, year_to: int) -> DataFrame:
    """Links of the patents filed in a range of years."""
    ids = in_years(t.patents, year_from, year_to).select("patent_id")
    return links.join(ids, "patent_id", "left_semi")


def patents_per_entity(t: Tables, links: DataFrame, entities: DataFrame) -> DataFrame:
    """``entities`` with links, plus their number of distinct patents, ``patent_count``."""
    key = entities.columns[0]
    if t.unique_links:
        count = F.count("patent_id")
    else:
        count = F.countDistinct("patent_id")
    counted = links.groupBy(key).agg(count.alias("patent_count"))
    return counted.join(entities, key)


def inventor_counts(
    t: Tables, year_from: int | None = None, year_to: int | None = None
) -> DataFrame:
    """inventor_id, patent_count, name, country of all inventors with links."""
    return _entity_counts(t, "inventor_years", t.patent_inventors, t.inventors, year_from, year_to)


def company_counts(
    t: Tables, year_from: int | None = None, year_to: int | None = None
) -> DataFrame:
    """company_id, patent_count, name, country of all companies with links."""
    return _entity_counts(t, "company_years", t.patent_companies, t.companies, year_from, year_to)


def _entity_counts(
    t: Tables, cells: str, links: DataFrame, entities: DataFrame,
    year_from: int | None, year_to: int | None,
) -> DataFrame:
    """Of the patents filed in a range of years; without a range, of all links."""
    if t.cube:
        return per_key(t.cube[cells], year_from, year_to).join(entities, entities.columns[0])
    if year_from is not None or year_to is not None:
        links = filed_in(links, t, year_from, year_to)
    return patents_per_entity(t, links, entities)


def country_counts(
    t: Tables, year_from: int | None = None, year_to: int | None = None
) -> DataFrame:
    """country, patent_count of all known inventor countries."""
    if t.cube:
        return per_key(t.cube["country_years"], year_from, year_to)
    links = t.patent_inventors
    if year_from is not None or year_to is not None:
        links = filed_in(links, t, year_from, year_to)
    return patents_per_country(links, t.inventors)


def per_key(cells: DataFrame, year_from: int | None, year_to: int | None) -> DataFrame:
    """The key of stored cells by year and ``patent_count`` in a range of years; without a range, of
    all patents, those without a year included."""
    if year_from is not None or year_to is not None:
        cells = in_years(cells, year_from, year_to)
    return cells.groupBy(cells.columns[0]).agg(F.sum("patents").alias("patent_count"))


def homes(inventors: DataFrame) -> DataFrame:
    """inventor_id, country of inventors of a known country, to be joined with single links.

    The hint makes AQE measure the table before that join, whatever it is derived from: it is
    broadcast only if it turns out to be small.
    """
    found = inventors.where(known(F.col("country"))).select("inventor_id", "country")
    return found.hint("rebalance")


def patents_per_country(links: DataFrame, inventors: DataFrame) -> DataFrame:
    """``country, patent_count`` over inventors of a known country."""
    pairs = links.join(homes(inventors), "inventor_id").select("country", "patent_id").distinct()
    return pairs.groupBy("country").agg(F.count("patent_id").alias("patent_count"))


def links_per_country(links: DataFrame, inventors: DataFrame) -> DataFrame:
    """``country, links`` over inventors of a known country."""
    return (
        links.groupBy("inventor_id").agg(F.count("*").alias("links"))
        .join(homes(inventors), "inventor_id")
        .groupBy("country").agg(F.sum("links").alias("links"))
    )


def with_share(counts: DataFrame, t: Tables) -> DataFrame:
    """Add ``share_pct``: patents in percent of all inventor links.

    The row count is a subquery of its own; on stored tables it reads no column at all.
    """
    whole = (
        t.cube["totals"].agg(F.max("inventor_links")) if t.cube
        else t.patent_inventors.agg(F.count("*"))
    ).scalar()
    return counts.withColumn("share_pct", percent(F.col("patent_count"), whole, 2))
