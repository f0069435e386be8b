"""SimHash near-duplicates: fingerprints, a grid join on segment popcounts, components.

A fingerprint is cut into segments and embedded as the vector of their popcounts. The Manhattan
distance of two such vectors is at most the Hamming distance of the fingerprints. The grid join
finds the pairs of vectors within the bound: the coordinates are dealt into more groups than
the distance may touch, so two vectors in range agree in some choice of whole groups, which is
their common cell. Pairs of a cell pass the Manhattan bound, then the exact distance.

A cell with more than ``max_cell`` different fingerprints is not paired. Its members are tied
through the fingerprints at half the distance instead, which gives the same components: two
fingerprints differ in at most d bits exactly if some third differs from one of them in at most
half of d, rounded down, and from the other in at most the rest.

Equal fingerprints are folded before all that, so copies cost nothing. Near copies are what the bit
distance says: a copy with a few other words often differs in more than two bits and is not linked.

* Null and empty texts have the fingerprint 0 and are linked like others.
* A null id is kept; it never names a component unless all ids of that component are null. Ties do not
  arise, as the smallest id names a component. Repeated rows are returned as often as given.
* Long texts are hashed in pieces of shingles; a task holds one text and its words.
* Empty tables give no rows. Only key and text are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from linkloom.llm.batches import map_texts
from linkloom.llm.components import components
from linkloom.llm.keys import boxed, unboxed
from linkloom.llm.store import Store

SEED = 42
SEGMENTS = 32
MAX_CELL = 256
_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """A bit is 1 if it is set in more than half of the hashes of all word shingles.

    Words are runs of anything but ASCII white space, with A-Z in lower case. Fewer words than
    a shingle has make one shingle; no words give 0.
    """
    words = text.lower().split()
    n = max(1, len(words) - shingle + 1) if words else 0
    counts = np.zeros(64, np.int64)
    for first in range(0, n, _AT_ONCE):
        digest = xxhash.xxh64_digest
        hashes = b"".join([
            digest(b" ".join(words[i : i + shingle]), SEED)
            for i in range(first, min(n, first + _AT_ONCE))
        ])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the 64-bit fingerprint of each whole text."""
    return map_texts(docs, text, keep, "fingerprint long", lambda group: {
        "fingerprint": [fingerprint(t, shingle) for t in group]
    })


def _segments(c: Column) -> list[Column]:
    """The popcounts of all segments."""
    width = 64 // SEGMENTS
    mask = (1 << width) - 1
    return [
        F.bit_count(F.shiftrightunsigned(c, width * i).bitwiseAND(F.lit(mask)))
        for i in range(SEGMENTS)
    ]


def _group_keys(c: Column, groups: int) -> list[Column]:
    """The popcounts of each group of segments, packed in one number.

    Segments are dealt in turn, so groups differ by one in size.
    """
    counts = _segments(c)
    return [
        reduce(lambda key, n: F.shiftleft(key, 2) + n, [x.cast("long") for x in counts[g::groups]])
        for g in range(groups)
    ]


def _manhattan(a: Column, b: Column) -> Column:
    pairs = zip(_segments(a), _segments(b), strict=True)
    return reduce(lambda x, y: x + y, [F.abs(x - y) for x, y in pairs])


def cells(prints: DataFrame, distance: int, spare: int = 3) -> DataFrame:
    """``cell`` and ``fingerprint``: every choice of whole groups that can agree."""
    groups = distance + spare
    keys = _group_keys(F.col("fingerprint"), groups)
    chosen = [
        F.xxhash64(F.lit(i), *[keys[g] for g in choice])
        for i, choice in enumerate(combinations(range(groups), spare))
    ]
    return prints.select(F.explode(F.array(*chosen)).alias("cell"), "fingerprint")


def _flips(radius: int) -> list[int]:
    """All masks of at most ``radius`` bits."""
    return [
        sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(64), n)
    ]


def links(prints: DataFrame, distance: int, store: Store, max_cell: int = MAX_CELL) -> DataFrame:
    """``a`` > ``b`` with the components of all fingerprints within ``distance`` bits.

    ``prints`` has different fingerprints. In cells of at most ``max_cell`` they are the pairs
    themselves; in larger ones a star around every fingerprint at half the distance. Cells are
    named by a hash; a collision only adds pairs that the distance then rejects.
    """
    table = store.put("cells", cells(prints, distance))
    # Written, so that the join may split the rows of a crowded cell.
    size = store.put("sizes", table.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1"))
    table = store.put("shared_cells", table.join(size, "cell"))
    small = table.where(F.col("n") <= max_cell)
    pairs = (
        small.alias("x").join(small.alias("y"), "cell")
        .select(F.col("x.fingerprint").alias("a"), F.col("y.fingerprint").alias("b"))
        .where("a > b")
        .where(_manhattan(F.col("a"), F.col("b")) <= distance)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    )
    crowded = table.where(F.col("n") > max_cell).select("fingerprint").distinct()
    inner = distance // 2
    masks = F.array(*[
        F.struct(F.lit(_signed(m)).alias("m"), F.lit(m.bit_count() <= inner).alias("inner"))
        for m in _flips(distance - inner)
    ])
    near = crowded.select("fingerprint", F.inline(masks)).select(
        "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("m")).alias("third"), "inner"
    )
    hubs = near.groupBy("third").agg(
        F.min(F.when(F.col("inner"), F.col("fingerprint"))).alias("hub"), F.count("*").alias("n")
    )
    tie = near.join(hubs.where("n > 1 AND hub IS NOT NULL"), "third").where("fingerprint <> hub")
    stars = tie.select(
        F.greatest("fingerprint", "hub").alias("a"), F.least("fingerprint", "hub").alias("b")
    ).distinct()
    return store.put("links", pairs.union(stars))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_duplicates(
    docs: DataFrame,
    shingle: int,
    distance: int,
    key: str = "doc_id",
    text: str = "text",
    max_cell: int = MAX_CELL,
) -> DataFrame:
    """``key``, ``fingerprint`` and ``component_id``, the smallest key of the component."""
    store = Store(docs.sparkSession)
    marked = store.put("fingerprints", fingerprints(docs, shingle, [key], text))
    prints = store.put(
        "prints", marked.groupBy("fingerprint").agg(F.min(key).alias("least"))
    )
    tied = components(links(prints.select("fingerprint"), distance, store, max_cell), store, "tied")
    rooted = prints.join(
        tied.select(F.col("a").alias("fingerprint"), F.col("b").alias("root")),
        "fingerprint", "left",
    ).withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = store.put("rooted", rooted)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    names = store.put("names", rooted.join(named, "root").select("fingerprint", "component_id"))
    return marked.join(names, "fingerprint").select(key, "fingerprint", "component_id")


def keep_one(
    docs: DataFrame, shingle: int, distance: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest id, then text; a
    null id comes last. Of rows equal in id and text one stays."""
    rows = boxed(docs, key, text)
    place = F.struct(
        F.col("_row")[key].isNull().alias("n"), F.col("_row")[key].alias("id"), "_key"
    )
    found = near_duplicates(
        rows.select(place.alias("place"), F.col("_row")[text].alias("text")),
        shingle, distance, "place", "text",
    )
    staying = found.where(F.col("place") == F.col("component_id")).select("place._key").distinct()
    kept = rows.join(staying.hint("merge"), "_key", "left_semi").dropDuplicates(["_key"])
    return unboxed(kept, docs.columns)
