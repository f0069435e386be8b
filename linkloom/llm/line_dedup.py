"""Line deduplication by a suffix array over sequences of line ids.

Every document is the sequence of its lines that hold more than white space, ended by a mark of
its own, so that nothing is common across document ends. Prefix doubling sorts all suffixes:
the rank of a suffix by its first 2k lines follows from the ranks by k lines of itself and of
the suffix k lines on. Documents leave the rounds once all their suffixes are told apart.
Neighbours of the suffix array get their longest common prefix (LCP): the round that told two
of them apart gives its power of two, and comparing the lines from there gives the rest. That
is done only where the preceding lines differ; elsewhere the LCP is one less than for the line
before. A maximal stretch of neighbours with an LCP of ``min_lines`` or more, an LCP interval,
is a repeated run; all occurrences but the first lose its lines. With ``min_words`` a single line
of so many words, parted by ASCII white space, is a run as well.

* Of ties the first occurrence is that of the smallest document id, then text, then line; a null id
  comes last. Rows equal in id and text are one document: each is returned, with the same lines.
* Null texts stay null, empty ones empty. Lines are compared as they are, by a 128-bit hash, split at
  line feeds. Empty tables give no rows.
* A long text is one row; its lines are an array of 16 bytes each.
* Other columns stay as they are, whatever their names, but for ``lines_deleted``, which is replaced.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from linkloom.llm.batches import map_texts
from linkloom.llm.keys import boxed, row_key
from linkloom.llm.ordering import with_run_starts
from linkloom.llm.store import Store


def _line_ids(text: bytes, min_words: int | None) -> tuple[list[int], list[bytes], list[int]]:
    lines = [(i, x) for i, x in enumerate(text.split(b"\n")) if x.strip()]
    wide = [] if min_words is None else [
        i for i, (_, x) in enumerate(lines) if len(x.split()) >= min_words
    ]
    return [i for i, _ in lines], [xxhash.xxh3_128_digest(x) for _, x in lines], wide


def _sequences(
    docs: DataFrame, key: str, text: str, store: Store, min_words: int | None = None
) -> DataFrame:
    """``doc`` (a number), ``_key``, ``id``, ``places``, ``lines`` and ``wide``, which of the
    lines have ``min_words`` words, of every document."""

    def digest(texts: list[bytes]) -> dict[str, list]:
        made = [_line_ids(t, min_words) for t in texts]
        return dict(zip(("places", "lines", "wide"), map(list, zip(*made)), strict=True))

    keyed = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")) \
        .withColumn("_key", row_key("id", "text"))
    schema = "places array<int>, lines array<binary>, wide array<int>"
    split = map_texts(keyed, "text", ["_key", "id"], schema, digest)
    once = split.groupBy("_key").agg(
        F.first("id").alias("id"), F.first("places").alias("places"),
        F.first("lines").alias("lines"), F.first("wide").alias("wide"),
    ).where(F.size("lines") > 0)
    return store.put("sequences", once.withColumn("doc", F.monotonically_increasing_id()))


def suffix_array(sequences: DataFrame, store: Store) -> tuple[DataFrame, DataFrame]:
    """Two tables: the ids of lines (``doc``, ``i``, ``line``) that occur more than once or
    stand in a document with such a line, and the sorted suffixes that share their first line
    with others (``doc``, ``i``, ``rank``, ``apart``).

    ``apart`` is the largest power of two of lines that a suffix shares with the one before it
    in the order, 0 for none.
    """
    rows = sequences.select("doc", F.posexplode("lines").alias("i", "line"))
    now = with_run_starts(rows, ["line", "doc", "i"], {"rank": ["line"]}, store, "depth_1")
    by_doc = Window.partitionBy("doc")
    alive = now.withColumn("live", F.max("shared").over(by_doc)).where("live")
    lines = store.put("lines", alive.select("doc", "i", F.col("rank").alias("line"), "shared"))
    now = lines.select("doc", "i", F.col("line").alias("rank"), F.lit(0).alias("apart"), "shared")
    lines = lines.drop("shared")
    depth, finished = 1, None
    while True:
        alive = now.withColumns({
            "next": F.lead("rank", depth).over(by_doc.orderBy("i")),
            "live": F.max("shared").over(by_doc),
        }).where("live").select(
            "doc", "i", "rank", "apart", "shared",
            F.coalesce("next", F.lit(-1)).alias("next"),
            # The end of a document is a symbol of its own.
            F.when(F.col("next").isNull(), F.col("doc")).otherwise(-1).alias("end"),
        )
        order = ["rank", "next", "end", "doc", "i"]
        runs = {"old": order[:1], "new": order[:3]}
        placed = with_run_starts(alive.drop("shared"), order, runs, store, f"depth_{2 * depth}")
        split = F.col("new") != F.col("old")
        now = placed.select(
            "doc", "i",
            (F.col("rank") + F.col("new") - F.col("old")).alias("rank"),
            F.when(split, depth).otherwise(F.col("apart")).alias("apart"),
            (F.col("shared") & (F.col("end") < 0)).alias("shared"), "new", "at",
        )
        # Suffixes that all rounds from here on leave as they are.
        done = now.select("doc", "i", "rank", "apart", F.max("shared").over(by_doc).alias("live"))
        ended = done.where(~F.col("live")).drop("live")
        finished = ended if finished is None else finished.unionByName(ended)
        if now.where("new <> at").isEmpty():
            rest = done.where("live").drop("live")
            return lines, store.put("suffixes", finished.unionByName(rest))
        now = now.drop("new", "at")
        depth *= 2


def with_common_prefix(lines: DataFrame, suffixes: DataFrame, store: Store) -> DataFrame:
    """``suffixes`` with ``lcp``, the lines each has in common with the one before it."""
    by_doc = Window.partitionBy("doc").orderBy("i")
    before = lines.withColumn("left", F.coalesce(F.lag("line").over(by_doc), -1 - F.col("doc")))
    rows = store.put("ranked", suffixes.join(before.drop("line"), ["doc", "i"]))
    a = rows.where("apart > 0").select("rank", "doc", "i", "apart", "left")
    b = rows.select(
        (F.col("rank") + 1).alias("rank"), *[F.col(c).alias(f"{c}_b") for c in ("doc", "i", "left")]
    )
    pairs = a.join(b, "rank").where("left <> left_b")
    whole = (
        lines.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("i", "line"))).alias("s"))
        .select("doc", F.transform("s", lambda x: x["line"]).alias("s"))
    )
    sides = pairs.select(
        "rank", "apart", F.inline(F.array(
            F.struct(F.lit(0).alias("side"), F.col("doc").alias("of"), F.col("i").alias("p")),
            F.struct(F.lit(1).alias("side"), F.col("doc_b").alias("of"), F.col("i_b").alias("p")),
        ))
    ).select("rank", "side", "apart", F.col("of").alias("doc"), "p")
    # A piece is no longer than the prefix known to be common.
    pieces = sides.join(whole, "doc").select(
        "rank", "side", "apart", F.slice("s", F.col("p") + F.col("apart") + 1, F.col("apart")).alias("s")
    )
    def side(n: int) -> Column:
        return F.max(F.when(F.col("side") == n, F.col("s")))

    both = pieces.groupBy("rank", "apart").agg(side(0).alias("x"), side(1).alias("y"))
    differ = F.array_position(F.zip_with("x", "y", lambda p, q: p == q), False)
    more = F.when(differ > 0, differ - 1).otherwise(F.least(F.size("x"), F.size("y")))
    known = both.select("rank", (F.col("apart") + more).alias("lcp"))
    joined = rows.join(known, "rank", "left")
    reach = F.last(F.col("i") + F.col("lcp"), ignorenulls=True).over(by_doc)
    lcp = F.when(F.col("apart") > 0, reach - F.col("i")).otherwise(0)
    return store.put("common", joined.withColumn("lcp", lcp).select("doc", "i", "rank", "lcp"))


def _place() -> Column:
    return F.struct(F.col("id").isNull().alias("n"), "id", "_key", "i")


def _repeated_wide_lines(sequences: DataFrame, store: Store) -> DataFrame:
    wide = sequences.select("doc", "id", "_key", F.inline(F.transform(
        "wide", lambda i: F.struct(i.alias("i"), F.get("lines", i).alias("line"))
    )))
    first = store.put("first_wide", wide.groupBy("line").agg(
        F.min(_place()).alias("least"), F.count("*").alias("n")
    ).where("n > 1").drop("n"))
    return wide.join(first.hint("merge"), "line").select(
        "doc", "i", (_place() == F.col("least")).alias("first"), F.lit(1).alias("n")
    )


def repeated_runs(
    docs: DataFrame, min_lines: int, key: str, text: str, store: Store, min_words: int | None = None
) -> DataFrame:
    """``doc``, ``i``, ``first`` and ``n``: where a run of ``n`` lines begins that occurs
    elsewhere, and whether this is its first occurrence. Runs have ``min_lines`` lines, or one
    of ``min_words`` words."""
    sequences = _sequences(docs, key, text, store, min_words)
    lines, suffixes = suffix_array(sequences, store)
    common = with_common_prefix(lines, suffixes, store)
    inside = with_run_starts(
        common.where(F.col("lcp") >= min_lines), ["rank"], {}, store, "inside"
    ).withColumn("interval", F.col("rank") - F.col("at"))
    heads = inside.groupBy("interval").agg((F.min("rank") - 1).alias("rank"))
    members = inside.select("doc", "i", "interval").unionByName(
        common.join(heads, "rank").select("doc", "i", "interval")
    )
    members = members.join(sequences.select("doc", "id", "_key"), "doc")
    # Written, so that the join has plain shuffles on both sides and a frequent run is split.
    first = store.put("first", members.groupBy("interval").agg(F.min(_place()).alias("least")))
    runs = members.join(first, "interval").select(
        "doc", "i", (_place() == F.col("least")).alias("first"), F.lit(min_lines).alias("n")
    )
    return runs if min_words is None else runs.unionByName(_repeated_wide_lines(sequences, store))


def delete_repeated_runs(
    docs: DataFrame,
    min_lines: int = 2,
    key: str = "doc_id",
    text: str = "text",
    min_words: int | None = None,
) -> DataFrame:
    """``docs`` with the lines of later copies deleted, and ``lines_deleted``.

    Without ``min_words`` a repeated run of fewer than ``min_lines`` lines stays, however long
    they are.

    A document all of whose lines go keeps an empty text; what to do with it is the caller's
    choice. A column ``lines_deleted`` of the input is replaced.
    """
    store = Store(docs.sparkSession)
    runs = repeated_runs(docs, min_lines, key, text, store, min_words).where(~F.col("first"))
    covered = runs.select(
        "doc", F.explode(F.sequence("i", F.col("i") + F.col("n") - 1)).alias("i")
    ).groupBy("doc").agg(F.collect_set("i").alias("gone"))
    sequences = store.spark.read.parquet(store.path("sequences"))
    # Places of the deleted lines among all lines of the text, blank ones included.
    gone = store.put("gone", sequences.join(covered, "doc").select(
        "_key", F.transform("gone", lambda i: F.get("places", i)).alias("_gone")
    ))
    # One plan at all sizes: the deletions of a large corpus outgrow any broadcast.
    marked = boxed(docs, key, text).join(gone.hint("merge"), "_key", "left")
    whole = F.col("_row")[text]
    # Bound as a variable, so that the text is split once.
    kept = F.transform(F.array(F.split(whole, "\n", -1)), lambda lines: F.array_join(
        F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "_gone"),
            lambda place: F.get(lines, place),
        ), "\n",
    ))[0]
    left = {text: F.when(F.col("_gone").isNull(), whole).otherwise(kept)}
    names = [c for c in docs.columns if c != "lines_deleted"]
    return marked.select(
        *[left.get(c, F.col("_row")[c]).alias(c) for c in names],
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("lines_deleted"),
    )


def keep_new_lines(
    docs: DataFrame, min_lines: int = 2, text: str = "text", min_words: int | None = None
) -> DataFrame:
    """``docs`` without later copies of runs. A document that loses all its lines goes.

    ``n_chars``, where present, is the length of the text that is left.
    """
    names, taken = docs.columns, "lines_deleted"
    if taken in names:
        docs = docs.withColumnRenamed(taken, "_lines_deleted")
    kept = delete_repeated_runs(docs, min_lines, text=text, min_words=min_words)
    changed = F.col(taken) > 0
    kept = kept.where(~changed | F.col(f"`{text}`").rlike(r"\S"))
    if "n_chars" in names:
        length = F.length(f"`{text}`").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    if taken in names:
        kept = kept.drop(taken).withColumnRenamed("_lines_deleted", taken)
    return kept.select(*[f"`{c}`" for c in names])
