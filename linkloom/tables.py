"""The five model tables as one value."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from linkloom.schemas import MODEL


@dataclass(frozen=True)
class Tables:
    """Entities, and the two many-to-many link tables between them.

    Entity keys are unique. ``unique_links`` says that no link pair repeats either, as in
    tables this package cleaned or wrote; patents per entity are then a plain count, which
    needs no shuffle of the links. Leave it off for frames of unknown origin.

    ``cube`` may hold counts by year stored beforehand (:mod:`linkloom.operators.cube`), from which
    counts are then taken instead of from the links. ``version`` names the content, where known.
    """

    patents: DataFrame
    inventors: DataFrame
    companies: DataFrame
    patent_inventors: DataFrame
    patent_companies: DataFrame
    unique_links: bool = False
    cube: dict[str, DataFrame] = field(default_factory=dict)
    version: str | None = None

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in MODEL]

    def register_views(self) -> None:
        """Expose the tables to ``spark.sql`` under their own names."""
        for name, frame in self.items():
            frame.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str, **args) -> DataFrame:
    """Free-form SQL on the registered views; ``:name`` markers take ``args``."""
    return spark.sql(sql, args=args)
