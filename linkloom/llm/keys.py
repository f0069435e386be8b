"""A key for rows whose ids may be missing or repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def row_key(key: str, text: str) -> Column:
    """16 bytes made of id and text: rows equal in both are the same document."""
    name = F.col(f"`{key}`").cast("string")
    return F.unhex(F.md5(F.concat(
        F.coalesce(name, F.lit("")), F.lit("|"), name.isNull().cast("string"), F.lit("|"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")),
    )))


def boxed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_key`` and all columns as one, ``_row``, so that their names clash with nothing."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row_key(key, text).alias("_key"), row.alias("_row"))


def unboxed(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("_row")[c].alias(c) for c in columns])
