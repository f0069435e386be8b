"""Top-k and ranks. Ranks are computed on the k rows kept, never on a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top(df: DataFrame, k: int, by: str, key: str) -> DataFrame:
    """The ``k`` rows largest in ``by``; ``key`` decides ties."""
    return df.orderBy(F.desc(by), F.asc(key)).limit(k)


def positions(top_rows: DataFrame, by: str, key: str, name: str) -> DataFrame:
    """Number the rows of a top-k 1, 2, 3 ...; equal values get different numbers."""
    order = Window.orderBy(F.desc(by), F.asc(key))
    return top_rows.select(F.row_number().over(order).alias(name), "*")


def competition_rank(by: str) -> Column:
    """RANK within the rows of a top-k. It equals the rank within the whole table, as all
    rows with a larger value are among the k."""
    return F.rank().over(Window.orderBy(F.desc(by)))


def group_rank(by: str, group: str) -> Column:
    """DENSE_RANK per group within the rows of a top-k, likewise equal to the full one."""
    return F.dense_rank().over(Window.partitionBy(group).orderBy(F.desc(by)))


def first_per_group(df: DataFrame, group: str, order: str, k: int) -> DataFrame:
    """The first ``k`` rows of each group. Spark cuts each task's rows before the shuffle."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")
