"""Connected components of a table of links, by large-star and small-star steps.

Each step is an aggregation, written to the shared folder, and a join with it on the node. A node with
very many links is folded in each task, and as both sides of the join are plain shuffles of written
tables, its rows may be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkloom.llm.store import Store


def _stars(links: DataFrame, both: bool, store: Store, name: str) -> DataFrame:
    """Tie neighbours to the smallest one around each node: the larger ones (``both``: links
    are read in both directions), or the node itself and its smaller ones."""
    if both:
        links = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = store.put(name, links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
    if not both:
        itself = links.select("a", F.col("a").alias("b"))
        links = links.union(itself)
    tied = links.join(least, "a").where("b > a" if both else "b <> m")
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def components(links: DataFrame, store: Store, name: str) -> DataFrame:
    """``a``, ``b`` for every node ``a`` that is not the smallest of its component ``b``.

    ``links`` has two columns ``a``, ``b`` with a > b. Rounds grow with the logarithm of the
    nodes, not with the length of chains.
    """
    now = store.put(f"{name}_0", links.distinct())
    seen, step = None, 0
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            return now
        seen = tuple(mark)
        step += 1
        large = store.put(f"{name}_large_{step}", _stars(now, True, store, f"{name}_least_{step}"))
        now = store.put(f"{name}_{step}", _stars(large, False, store, f"{name}_smallest_{step}"))
