"""Cleaners for the five raw files.

The ``*_stage`` functions return counted stages (see :mod:`linkloom.operators.dedup`), from
which both the clean rows and the drop report come; ``clean_*`` return the clean rows.
``order`` says which of several rows with one key came first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from linkloom.functions import text
from linkloom.operators.dedup import first_reason, keep_first, kept
from linkloom.schemas import MODEL, REASONS, YEARS
from linkloom.sources.delimited import ORDINAL


def _stage(rows: DataFrame, table: str, order: Column | None, *required: Column) -> DataFrame:
    """``required`` are the conditions whose failure :data:`REASONS` names, in its order."""
    key, *payload = MODEL[table].names
    reasons = dict(zip(REASONS[table], required, strict=True))
    return keep_first(rows, [key], payload, F.col(ORDINAL) if order is None else order, reasons)


def patents_stage(raw: DataFrame, order: Column | None = None) -> DataFrame:
    day = text.lenient_date(F.col("date"))
    rows = raw.withColumns({
        "title": text.collapse_spaces(F.col("title")),
        "abstract": text.blank_to_null(text.collapse_spaces(F.col("abstract"))),
        "filing_date": day,
        "year": F.year(day),
    })
    return _stage(
        rows, "patents", order,
        F.col("patent_id").isNotNull(), F.length("title") > 0,
        F.col("filing_date").isNotNull(), F.col("year").between(YEARS[0], YEARS[-1]),
    )


def inventors_stage(
    raw: DataFrame, order: Column | None = None, literal_nulls: bool = False
) -> DataFrame:
    first, last = (text.text_or_empty(raw, n) for n in ("name_first", "name_last"))
    rows = raw.withColumns({
        "inventor_id": text.first_present(raw, "disambig_inventor_id", "inventor_id"),
        "name": text.strip(F.concat_ws(" ", first, last)),
        "country": text.country_code(F.col("country"), literal_nulls),
    })
    return _stage(rows, "inventors", order, F.length("name") > 0)


def companies_stage(
    raw: DataFrame, order: Column | None = None, literal_nulls: bool = False
) -> DataFrame:
    rows = raw.withColumns({
        "company_id": text.first_present(raw, "disambig_assignee_id", "assignee_id"),
        "name": text.text_or_empty(raw, "organization"),
        "country": text.country_code(F.col("country"), literal_nulls),
    })
    return _stage(rows, "companies", order, F.length("name") > 0)


def clean_patents(raw: DataFrame, order: Column | None = None) -> DataFrame:
    """patent_id, title, abstract, filing_date, year; the first valid row per patent."""
    return kept(patents_stage(raw, order))


def clean_inventors(
    raw: DataFrame, order: Column | None = None, literal_nulls: bool = False
) -> DataFrame:
    """inventor_id, name, country; the first named row per inventor."""
    return kept(inventors_stage(raw, order, literal_nulls))


def clean_companies(
    raw: DataFrame, order: Column | None = None, literal_nulls: bool = False
) -> DataFrame:
    """company_id, name, country; the first named row per company."""
    return kept(companies_stage(raw, order, literal_nulls))


def clean_patent_inventors(
    raw: DataFrame, patents: DataFrame, inventors: DataFrame, counted: bool = False
) -> DataFrame:
    """Distinct (patent_id, inventor_id) pairs whose two ends both exist, or the counted stage of them."""
    if counted:
        return patent_inventors_stage(raw, patents, inventors)
    inventor = text.first_present(raw, "disambig_inventor_id", "inventor_id")
    return _links(raw, inventor.alias("inventor_id"), patents, inventors)


def clean_patent_companies(
    raw: DataFrame, patents: DataFrame, companies: DataFrame, counted: bool = False
) -> DataFrame:
    """Distinct (patent_id, company_id) pairs whose two ends both exist, or the counted stage of them."""
    if counted:
        return patent_companies_stage(raw, patents, companies)
    company = text.first_present(raw, "disambig_assignee_id", "assignee_id")
    return _links(raw, company.alias("company_id"), patents, companies)


def patent_inventors_stage(
    raw: DataFrame, patents: DataFrame, inventors: DataFrame
) -> DataFrame:
    """The counted stage of :func:`clean_patent_inventors`."""
    inventor = text.first_present(raw, "disambig_inventor_id", "inventor_id")
    return _links_stage(raw, inventor.alias("inventor_id"), patents, inventors, "patent_inventors")


def patent_companies_stage(
    raw: DataFrame, patents: DataFrame, companies: DataFrame
) -> DataFrame:
    """The counted stage of :func:`clean_patent_companies`."""
    company = text.first_present(raw, "disambig_assignee_id", "assignee_id")
    return _links_stage(raw, company.alias("company_id"), patents, companies, "patent_companies")


def _links_stage(
    raw: DataFrame, entity: Column, patents: DataFrame, entities: DataFrame, table: str
) -> DataFrame:
    """Every different pair with ``_valid``, ``_reason`` and the number of its rows, ``_rows``.

    As in :func:`_links` copies collapse before any shuffle, pairs without a key into one row, and
    AQE may split a frequent key in either join, as only new shuffles follow.
    """
    pairs = raw.select("patent_id", entity)
    key = pairs.columns[1]
    whole = F.col("patent_id").isNotNull() & F.col(key).isNotNull()
    counted = pairs.select(
        F.when(whole, F.col("patent_id")).alias("patent_id"), F.when(whole, F.col(key)).alias(key)
    ).groupBy("patent_id", key).agg(F.count("*").alias("_rows"))
    checked = (
        counted.join(entities.select(key, F.lit(True).alias("_entity")), key, "left")
        .join(patents.select("patent_id", F.lit(True).alias("_patent")), "patent_id", "left")
    )
    there = [F.col(key).isNotNull(), F.col("_entity"), F.col("_patent")]
    reason = first_reason(dict(zip(REASONS[table], there, strict=True)))
    return checked.select("patent_id", key, reason.alias("_reason"), "_rows").select(
        "patent_id", key, F.col("_reason").isNull().alias("_valid"), "_reason", "_rows"
    )


def _links(raw: DataFrame, entity: Column, patents: DataFrame, entities: DataFrame) -> DataFrame:
    """Copies of a pair collapse before any shuffle, and the first shuffle is on the pair.

    A patent or entity holding a large part of all links is thus spread over all tasks;
    in the two semi-joins AQE may split its partition, as only new shuffles follow. For
    that, pass entities as written tables, not as the aggregates the cleaners return.
    """
    pairs = raw.select("patent_id", entity)
    key = pairs.columns[1]
    return (
        pairs.where(F.col("patent_id").isNotNull() & F.col(key).isNotNull())
        .distinct()
        .join(entities.select(key), key, "left_semi")
        .join(patents.select("patent_id"), "patent_id", "left_semi")
        .select("patent_id", key)
    )
