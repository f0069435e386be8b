"""Keep-first deduplication that also counts the rows it drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def first_reason(reasons: dict[str, Column]) -> Column:
    """The name of the first condition that does not hold for certain; null if all hold."""
    out = F.lit(None).cast("string")
    for name, holds in reversed(reasons.items()):
        out = F.when(F.coalesce(holds, F.lit(False)), out).otherwise(F.lit(name))
    return out


def keep_first(
    df: DataFrame, keys: list[str], payload: list[str], order: Column, required: dict[str, Column]
) -> DataFrame:
    """One row per key: the first row in ``order`` of those for which all of ``required`` hold.

    The result has ``keys``, ``payload``, ``_valid``, ``_reason`` and ``_rows``. Other rows are
    folded into one group per reason, under the null key, so the sum of ``_rows`` is the input row
    count. It is a plain aggregation: each task reduces its own copies of a key to one before
    the shuffle, so neither a very frequent key nor many bad rows reach one task whole.
    ``_valid`` is an aggregate too; filters on it thus stay above the shuffle, where they
    do not repeat the work of the expressions below it.
    """
    row = F.struct(order.alias("_order"), *payload)
    marked = df.withColumn("_reason", first_reason(required))
    ok = F.col("_reason").isNull()
    marked = marked.select(
        "_reason", *[F.when(ok, F.col(k)).alias(k) for k in keys], F.when(ok, row).alias("_row"),
    )
    folded = marked.groupBy(*keys, "_reason").agg(
        F.min("_row").alias("_row"), F.max(ok).alias("_valid"), F.count("*").alias("_rows")
    )
    return folded.select(
        *keys, *[F.col(f"_row.{p}").alias(p) for p in payload], "_valid", "_reason", "_rows"
    )


def kept(stage: DataFrame) -> DataFrame:
    """The surviving rows of a counted stage."""
    return stage.where("_valid").drop("_valid", "_reason", "_rows")
