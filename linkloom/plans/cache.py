"""Stored results of the interactive pages.

A result is kept under the query, its parameters and the version of the tables it was made from, so
that asking again reads it back, and a rebuild of the tables makes all kept results unreachable.
"""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkloom.plans import trends
from linkloom.sources import files
from linkloom.sources.parquet import read_tables
from linkloom.tables import Tables


class ResultCache:
    """Results below ``root`` that were made from ``version`` of some tables."""

    def __init__(self, spark: SparkSession, root: str, version: str):
        self.spark, self.root, self.version = spark, root.rstrip("/"), version

    def path(self, name: str, params: dict) -> str:
        key = json.dumps([name, params], sort_keys=True, default=str)
        return f"{self.root}/{self.version}/{name}-{hashlib.sha256(key.encode()).hexdigest()[:32]}"

    def get(self, name: str, build: Callable[[], DataFrame], **params) -> DataFrame:
        """The rows of ``build()``, made once for each ``name``, ``params`` and version.

        A result whose writing was cut short does not count and is made anew. Rows have no order,
        as rows of any table; sort them by their rank or year to show them.
        """
        path = self.path(name, params)
        if not files.is_complete(self.spark, path):
            build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def drop_others(self) -> None:
        """Delete the results of all other versions."""
        for version in files.children(self.spark, self.root):
            if version != self.version:
                files.delete(self.spark, f"{self.root}/{version}")


# The pages by name; each takes the tables and its parameters.
PAGES: dict[str, Callable[..., DataFrame]] = {
    "overview": trends.d_overview_totals,
    "yearly": trends.d_yearly,
    "growth": trends.d_yoy_growth,
    "top_inventors": trends.d_top_inventors,
    "top_companies": trends.d_top_companies,
    "countries": trends.d_countries,
    "country_trend": trends.d_country_trend_long,
}


class Pages:
    """The pages over the tables that the batch job stored, at the version current now."""

    def __init__(self, t: Tables, cache: ResultCache):
        self.t, self.cache = t, cache

    @classmethod
    def over(cls, spark: SparkSession, store: str) -> Pages:
        t = read_tables(spark, store, unique_links=True)
        if t.version is None:
            raise ValueError(f"{store} holds no published version")
        return cls(t, ResultCache(spark, f"{store}/results", t.version))

    def show(self, page: str, **params) -> DataFrame:
        """A page's rows; parameters that are left out have their defaults."""
        fn = PAGES[page]
        given = inspect.signature(fn).bind(self.t, **params)
        given.apply_defaults()
        named = {k: v for k, v in given.arguments.items() if k != "t"}
        return self.cache.get(page, lambda: fn(self.t, **named), **named)
