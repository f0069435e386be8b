"""Token counts: an exact histogram of encoded lengths with suffix sums.

The histogram has a row per length, however many documents there are. From its suffix sums
follow, for every context limit, how many documents are at least that long, how many tokens
they have, what is left if all texts are cut there, and every quantile.

* Null and empty texts have length 0. Repeated rows count as often as they occur; documents of one
  length share a row, so there are no ties.
* Long texts are encoded whole; a task holds one text and its tokens. Empty tables give no rows.
* Only the text and kept columns are read, whatever the names of others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from linkloom.llm import byte_tokens
from linkloom.llm.batches import map_texts
from linkloom.llm.store import Store

# Suffix sums are taken within ranges of so many lengths, then over the ranges.
_RANGE = 4096


def lengths(
    docs: DataFrame, ranks: str, pattern: str, keep: list[str], text: str = "text"
) -> DataFrame:
    """``keep`` and ``n_tokens`` of each whole text."""
    shared = byte_tokens.share(docs.sparkSession, ranks, pattern)

    def count(texts: list[bytes]) -> dict[str, list]:
        one = byte_tokens.loaded(shared).count
        return {"n_tokens": [one(t.decode("utf-8", "replace")) for t in texts]}

    return map_texts(docs, text, keep, "n_tokens long", count)


def histogram(lengths: DataFrame) -> DataFrame:
    """``n_tokens``, ``docs``, and the suffix sums ``docs_at_least`` and ``tokens_at_least``;
    ``docs_total`` and ``tokens_total``; ``truncated_total``, the tokens left at that limit; and
    ``quantile``, the share of documents that are no longer."""
    counted = lengths.groupBy("n_tokens").agg(F.count("*").alias("docs"))
    # Written, so that the texts are encoded once although the counts are used twice.
    counts = Store(lengths.sparkSession).put("counts", counted) \
        .withColumn("_range", F.floor(F.col("n_tokens") / _RANGE))
    tokens = F.col("n_tokens") * F.col("docs")
    ranges = counts.groupBy("_range").agg(F.sum("docs").alias("_d"), F.sum(tokens).alias("_t"))
    longer = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("_range")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    # A row for each range of lengths.
    ranges = ranges.select(
        "_range",
        F.coalesce(F.sum("_d").over(longer), F.lit(0)).alias("_longer_docs"),
        F.coalesce(F.sum("_t").over(longer), F.lit(0)).alias("_longer_tokens"),
        F.sum("_d").over(every).alias("docs_total"), F.sum("_t").over(every).alias("tokens_total"),
    )
    within = Window.partitionBy("_range").orderBy(F.desc("n_tokens"))
    summed = counts.join(ranges, "_range").select(
        "n_tokens", "docs",
        (F.sum("docs").over(within) + F.col("_longer_docs")).alias("docs_at_least"),
        (F.sum(tokens).over(within) + F.col("_longer_tokens")).alias("tokens_at_least"),
        "docs_total", "tokens_total",
    )
    longer_docs = F.col("docs_at_least") - F.col("docs")
    return summed.withColumns({
        "truncated_total": F.col("tokens_total") - F.col("tokens_at_least")
        + F.col("n_tokens") * F.col("docs_at_least"),
        "quantile": (F.col("docs_total") - longer_docs) / F.col("docs_total"),
    })


def at_limits(hist: DataFrame, limits: DataFrame) -> DataFrame:
    """For every ``max_tokens`` of ``limits``: the documents that are longer, and the tokens left
    if texts are cut there. ``hist`` comes from :func:`histogram`; limits may lie between its
    lengths. An empty corpus has totals of 0."""
    wanted = limits.select("max_tokens").distinct()
    # The next length above a limit stands for all longer documents.
    above = wanted.join(hist, hist["n_tokens"] > wanted["max_tokens"], "left") \
        .groupBy("max_tokens").agg(F.min_by(F.struct("docs_at_least", "tokens_at_least"), "n_tokens").alias("s"))
    totals = hist.agg(F.coalesce(F.max("tokens_total"), F.lit(0)).alias("tokens_total"))
    docs = F.coalesce("s.docs_at_least", F.lit(0))
    return above.join(F.broadcast(totals)).select(
        "max_tokens", docs.alias("docs_longer"),
        (F.col("tokens_total") - F.coalesce("s.tokens_at_least", F.lit(0))
         + docs * F.col("max_tokens")).alias("truncated_total"),
    )


def at_quantile(hist: DataFrame, q: float) -> DataFrame:
    """``n_tokens``, the shortest length that a share ``q`` of all documents does not exceed."""
    return hist.where(F.col("quantile") >= q).agg(F.min("n_tokens").alias("n_tokens"))
