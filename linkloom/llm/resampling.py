"""Importance resampling towards a target: hashed features, array-scored weights, a bracketed cutoff.

Every run of 1 to ``n`` words falls into one of ``buckets`` (CRC-32). A bucket's gain is the log ratio
of its smoothed shares in the target and in the documents, as an integer. The buckets of a document
are one packed array, and its weight is the mean gain of that array, rounded down. Adding Gumbel
noise made of the document's id and taking the highest scores draws without replacement.

The cutoff is found without sorting all scores: a quantile sketch gives a bracket around it; exact
counts of the rows above and within either prove that the cutoff lies inside, or the bracket is
widened; only the bracket is sorted. Ranks then need the order of the drawn rows alone.

* Null and empty texts have no features and weight 0. They are scored, but have too few words to be
  drawn unless ``least_words`` is 0.
* Texts are read whole, whatever their length, in pieces of about a megabyte of words.
* Ties go to the smaller id, null last, then to fewer features. Repeated rows are documents of their
  own, with ranks of their own; an id that many rows share is spread over tasks by place in its file.
* Without documents there is no row; without target texts all target counts are 0. A null ``key``
  has the noise of an empty id.
* Columns but ``key`` and ``text`` are not read, so their names may be any.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F

from linkloom.llm.batches import map_texts
from linkloom.llm.ordering import with_run_starts
from linkloom.llm.store import Store, ship

SEED = 2024
# The sketch is asked for this share of rows on either side of the cutoff.
SPREAD = 0.005
_PIECE = 1 << 20
# A-Z in lower case; what is in no word becomes a blank.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_BLANK = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


@dataclass(frozen=True)
class Features:
    """Runs of 1 to ``n`` words, hashed into ``buckets`` (at most 65,536)."""

    n: int = 1
    buckets: int = 10_000

    def of(self, text: bytes) -> tuple[int, bytes]:
        """The number of words, and the bucket of each feature as two bytes."""
        crc, size, out, n_words, before, at = zlib.crc32, self.buckets, [], 0, [], 0
        while at < len(text):
            end = _BLANK.search(text, min(len(text), at + _PIECE))
            end = end.start() if end else len(text)
            words = text[at:end].translate(_LETTERS).split()
            n_words, at = n_words + len(words), end + 1
            hashed = [crc(w) % size for w in words]
            out.append(np.array(hashed, np.uint16))
            if self.n > 1:
                words = before + words
                for k in range(2, self.n + 1):
                    # Runs that end among the words of this piece.
                    first = max(0, len(before) - k + 1)
                    runs = (words[i : i + k] for i in range(first, len(words) - k + 1))
                    out.append(np.array([crc(b" ".join(r)) % size for r in runs], np.uint16))
                before = words[1 - self.n :]
        return n_words, b"".join(x.astype("<u2").tobytes() for x in out)

    def table(self, docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
        """``keep``, ``n_words`` and the packed ``packed`` buckets of each whole text."""

        def digest(texts: list[bytes]) -> dict[str, list]:
            counted, packed = zip(*map(self.of, texts), strict=True)
            return {"n_words": list(counted), "packed": list(packed)}

        return map_texts(docs, text, keep, "n_words long, packed binary", digest)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a batch one after the other, and the borders between its rows."""
    sizes = np.array([len(x.as_buffer()) // 2 for x in column], np.int64)
    ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
    data = b"".join(x.as_buffer() for x in column)
    return np.frombuffer(data, "<u2"), ends


def counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all rows: one row per bucket and task is summed."""
    ship(features.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column("packed"))[0], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": met, "n": total[met]})

    made = features.select("packed").mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in made.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """The log ratio of smoothed shares of each bucket, in thousandths, rounded down."""
    n, all_t, all_s = len(target), float(target.sum()), float(source.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (all_s + n) / ((s + 1) * (all_t + n))))
        for t, s in zip(map(float, target), map(float, source), strict=True)
    ], np.int64)


def _weighed(features: DataFrame, key: str, gain: np.ndarray) -> DataFrame:
    """``key``, ``n_words``, ``n_features`` and ``weight``."""
    ship(features.sparkSession)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, ends = _flat(batch.column("packed"))
            total = np.concatenate((np.zeros(1, np.int64), np.cumsum(gain[buckets])))[ends]
            n = np.diff(ends)
            weight = np.where(n > 0, np.diff(total) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("n_words"), pa.array(n), pa.array(weight)],
                ["_key", "n_words", "n_features", "weight"],
            )

    named = features.select(F.col(f"`{key}`").cast("long").alias("_key"), "n_words", "packed")
    return named.mapInArrow(weigh, "_key long, n_words long, n_features long, weight long")


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a SHA-256 of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


# What decides the order of rows; none is ever null.
_ORDER = {
    "_o_score": "-score", "_o_null": "CAST(_key IS NULL AS INT)", "_o_key": "coalesce(_key, 0L)",
    "_o_features": "n_features", "_o_place": "_place",
}


def _bracket(scored: DataFrame, drawn: int, total: int, spread: float) -> tuple[int, int, int]:
    """Two scores between which the last drawn row lies, ends included, and the rows above them."""
    while True:
        at = 1 - drawn / total
        shares = [max(0.0, at - spread), min(1.0, at + spread)]
        low, high = scored.agg(F.percentile_approx("score", shares, 10_000)).first()[0]
        if spread >= 1:
            low, high = scored.agg(F.min("score"), F.max("score")).first()
        above, inside = scored.agg(
            F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))
        ).first()
        if above < drawn <= above + inside:
            return low, high, above
        spread *= 4


def _cutoff(scored: DataFrame, drawn: int, total: int, store: Store, spread: float) -> Column:
    """True for the ``drawn`` first rows."""
    low, high, above = _bracket(scored, drawn, total, spread)
    inside = scored.where(F.col("score").between(low, high))
    placed = with_run_starts(inside.select(*_ORDER), list(_ORDER), {}, store, "bracket")
    last: Row = placed.where(F.col("at") == drawn - above - 1).select(*_ORDER).first()
    here, there = F.struct(*_ORDER), F.struct(*[F.lit(last[c]).alias(c) for c in _ORDER])
    return (F.col("score") > high) | ((F.col("score") >= low) & (here <= there))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int,
    least_words: int,
    features: Features = Features(),
    key: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    spread: float = SPREAD,
) -> DataFrame:
    """``key``, ``n_features``, ``weight``, ``score`` and ``rank`` for every document.

    Of the documents with ``least_words`` or more, ``percent`` of a hundred, rounded down, are drawn
    by the highest scores and get ranks from 1; others have none.
    """
    store = Store(docs.sparkSession)
    made = store.put("features", features.table(docs, [key], text))
    goal = features.table(target, [], text)
    gain = gains(counts(goal, features.buckets), counts(made, features.buckets))
    scored = _weighed(made, key, gain).withColumns({
        "score": F.col("weight") + noise(F.col("_key"), seed),
        "_place": F.monotonically_increasing_id(),
    })
    scored = store.put("scored", scored).withColumns({c: F.expr(x) for c, x in _ORDER.items()})
    able = F.col("n_words") >= least_words
    total = scored.where(able).count()
    drawn = total * percent // 100
    out = [F.col("_key").alias(key), "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return scored.select(*out, none)
    first = able & _cutoff(scored.where(able), drawn, total, store, spread)
    taken = with_run_starts(scored.where(first), list(_ORDER), {}, store, "drawn")
    return taken.select(*out, (F.col("at") + 1).alias("rank")).unionByName(
        scored.where(~first).select(*out, none)
    )
