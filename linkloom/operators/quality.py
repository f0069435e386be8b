"""Drop counts of the cleaners and integrity checks of the model tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkloom.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, REASONS
from linkloom.tables import Tables

REPORT_SCHEMA = "stage string, before bigint, after bigint"
REJECT_SCHEMA = "stage string, reason string, rows bigint"
COPY = "copy"


def stage_counts(stage: DataFrame, name: str) -> DataFrame:
    """``stage, before, after`` of a counted stage, in one pass over the raw rows."""
    return stage.agg(*count_columns()).select(F.lit(name).alias("stage"), "before", "after")


def count_columns() -> list[Column]:
    """Input and output rows of a counted stage, as aggregates over it."""
    return [
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("before"),
        F.count_if("_valid").alias("after"),
    ]


def reject_columns(table: str) -> list[Column]:
    """The rows of a counted stage that were dropped, by reason, as aggregates over it. With the rows
    that stay they add up to all."""
    copies = F.sum(F.when(F.col("_valid"), F.col("_rows") - 1))
    by_reason = {r: F.sum(F.when(F.col("_reason") == r, F.col("_rows"))) for r in REASONS[table]}
    return [
        F.coalesce(rows, F.lit(0)).alias(reason) for reason, rows in (by_reason | {COPY: copies}).items()
    ]


def stage_rejects(stage: DataFrame, table: str) -> DataFrame:
    """``stage, reason, rows`` for each reason there is to drop a row."""
    totals = stage.agg(*reject_columns(table))
    return totals.unpivot([], totals.columns, "reason", "rows").select(
        F.lit(table).alias("stage"), "reason", "rows"
    )


def rejects_frame(spark: SparkSession, rows: list[tuple[str, str, int]]) -> DataFrame:
    return spark.createDataFrame(rows, REJECT_SCHEMA)


def drop_report(counts: DataFrame) -> DataFrame:
    """Add the dropped rows and their percentage, 0 for an empty input."""
    dropped = F.col("before") - F.col("after")
    pct = F.when(F.col("before") > 0, F.round(dropped.cast("double") / F.col("before") * 100, 1))
    return counts.select(
        "stage", "before", "after",
        dropped.alias("dropped"), F.coalesce(pct, F.lit(0.0)).alias("pct"),
    )


def counts_frame(spark: SparkSession, rows: list[tuple[str, int, int]]) -> DataFrame:
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def integrity(t: Tables) -> DataFrame:
    """``table, check, violations`` for every key, NOT NULL and reference rule.

    ``unique`` counts key values that occur more than once, ``not_null`` counts rows, and
    ``references`` counts link rows whose key the other table lacks.

    The keys of one domain (patents, inventors, companies, and the pairs of each link table) are
    read from all tables that hold them as one tagged union, and counted by key and tag once. From
    that one row per key come repeated keys, missing ones and links to nothing together, for one
    shuffle of a row per key and task; nothing is joined, and a frequent key is folded before it.
    """
    parts = [_domain(t, parent) for parent in PRIMARY_KEYS if parent not in FOREIGN_KEYS]
    parts += [_pairs(t, table) for table in FOREIGN_KEYS]
    return reduce(DataFrame.unionByName, parts)


def _domain(t: Tables, parent: str) -> DataFrame:
    """All rules on the key of an entity table, there and in the links that refer to it."""
    (key,) = PRIMARY_KEYS[parent]
    others = [c for c in NOT_NULL[parent] if c != key]
    holders = [
        (table, column) for table, references in FOREIGN_KEYS.items()
        for column, to in references.items() if to == parent
    ]
    missing = [F.col(c).isNull().alias(f"_no_{c}") for c in others]
    keys = getattr(t, parent).select(F.col(key).alias("key"), F.lit(0).alias("tag"), *missing)
    for tag, (table, column) in enumerate(holders, 1):
        present = [F.lit(False).alias(f"_no_{c}") for c in others]
        rows = getattr(t, table).select(F.col(column).alias("key"), F.lit(tag).alias("tag"), *present)
        keys = keys.unionByName(rows)
    per_key = keys.groupBy("key").agg(
        *[F.count_if(F.col("tag") == tag).alias(f"_n{tag}") for tag in range(len(holders) + 1)],
        *[F.count_if(f"_no_{c}").alias(f"_no_{c}") for c in others],
    )
    named = F.col("key").isNotNull()

    def rows_of(tag: int, where: Column) -> Column:
        return F.sum(F.when(where, F.col(f"_n{tag}")).otherwise(0))

    rules = {
        (parent, f"unique({key})"): F.count_if(named & (F.col("_n0") > 1)),
        (parent, f"not_null({key})"): rows_of(0, ~named),
        **{(parent, f"not_null({c})"): F.sum(f"_no_{c}") for c in others},
    }
    for tag, (table, column) in enumerate(holders, 1):
        rules[table, f"not_null({column})"] = rows_of(tag, ~named)
        rules[table, f"references({column} -> {parent})"] = rows_of(tag, named & (F.col("_n0") == 0))
    return _as_rows(per_key, rules)


def _pairs(t: Tables, table: str) -> DataFrame:
    """Pairs that occur more than once."""
    key = PRIMARY_KEYS[table]
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
    per_pair = getattr(t, table).groupBy(*key).agg(F.count("*").alias("_n"))
    again = F.count_if(whole & (F.col("_n") > 1))
    return _as_rows(per_pair, {(table, f"unique({', '.join(key)})"): again})


def _as_rows(counted: DataFrame, rules: dict[tuple[str, str], Column]) -> DataFrame:
    """One aggregate per rule as one row per rule."""
    totals = counted.agg(*[
        F.coalesce(total, F.lit(0)).alias(f"_{i}") for i, total in enumerate(rules.values())
    ])
    return totals.select(F.inline(F.array(*[
        F.struct(
            F.lit(table).alias("table"), F.lit(check).alias("check"), F.col(f"_{i}").alias("violations"),
        )
        for i, (table, check) in enumerate(rules)
    ])))


class IntegrityError(ValueError):
    """Raised when tables break a key or reference rule."""


def require_integrity(t: Tables) -> None:
    """Raise on any violation. A null entity key is reported only: no link can match it,
    and the cleaners keep one such row as the key's first."""
    broken = [
        r for r in integrity(t).where("violations > 0").collect()
        if r.table in FOREIGN_KEYS or r.check != f"not_null({PRIMARY_KEYS[r.table][0]})"
    ]
    if broken:
        raise IntegrityError("; ".join(f"{r.table} {r.check}: {r.violations}" for r in broken))
