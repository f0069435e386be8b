"""Column names, types and keys of the raw files and of the five model tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Names of the raw files and the columns read from them. Columns a
# file lacks are skipped, columns not listed are never read.
RAW_FILES: dict[str, list[str]] = {
    "g_patent": ["patent_id", "title", "abstract", "date"],
    "g_inventor_disambiguated": [
        "inventor_id", "disambig_inventor_id", "name_first", "name_last", "country",
    ],
    "g_assignee_disambiguated": [
        "assignee_id", "disambig_assignee_id", "organization", "country",
    ],
    "g_patent_inventor": ["patent_id", "inventor_id", "disambig_inventor_id", "sequence"],
    "g_patent_assignee": ["patent_id", "assignee_id", "disambig_assignee_id", "sequence"],
}

# The texts pandas reads as missing by default.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Accepted filing years and the label of a missing country.
YEARS = range(1976, 2031)
UNKNOWN = "UNKNOWN"

_STRING = T.StringType()

MODEL: dict[str, T.StructType] = {
    "patents": T.StructType([
        T.StructField("patent_id", _STRING),
        T.StructField("title", _STRING),
        T.StructField("abstract", _STRING),
        T.StructField("filing_date", T.DateType()),
        T.StructField("year", T.IntegerType()),
    ]),
    "inventors": T.StructType([
        T.StructField("inventor_id", _STRING),
        T.StructField("name", _STRING),
        T.StructField("country", _STRING),
    ]),
    "companies": T.StructType([
        T.StructField("company_id", _STRING),
        T.StructField("name", _STRING),
        T.StructField("country", _STRING),
    ]),
    "patent_inventors": T.StructType([
        T.StructField("patent_id", _STRING),
        T.StructField("inventor_id", _STRING),
    ]),
    "patent_companies": T.StructType([
        T.StructField("patent_id", _STRING),
        T.StructField("company_id", _STRING),
    ]),
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "patents": ["patent_id"],
    "inventors": ["inventor_id"],
    "companies": ["company_id"],
    "patent_inventors": ["patent_id", "inventor_id"],
    "patent_companies": ["patent_id", "company_id"],
}

NOT_NULL: dict[str, list[str]] = {
    "patents": ["patent_id", "title"],
    "inventors": ["inventor_id", "name"],
    "companies": ["company_id", "name"],
    "patent_inventors": ["patent_id", "inventor_id"],
    "patent_companies": ["patent_id", "company_id"],
}

# table -> {column: table whose key it must match}
FOREIGN_KEYS: dict[str, dict[str, str]] = {
    "patent_inventors": {"patent_id": "patents", "inventor_id": "inventors"},
    "patent_companies": {"patent_id": "patents", "company_id": "companies"},
}

# Why a cleaner drops a row, the first reason that holds; later copies of a key come on top.
REASONS: dict[str, list[str]] = {
    "patents": ["no id", "no title", "bad date", "year out of range"],
    "inventors": ["no name"],
    "companies": ["no name"],
    "patent_inventors": ["no key", "unknown inventor", "unknown patent"],
    "patent_companies": ["no key", "unknown company", "unknown patent"],
}
