"""Removal of repeated byte strings by a sparse suffix array with deep-shallow sorting.

Every window of ``length`` bytes has an anchor: the place in it where the hash of the next ``grain``
bytes is least. Equal windows have their anchors at the same place, so two copies of a
window are two anchors that agree in what stands left and right of them. Only anchors whose
grain occurs more than once go on. Anchors equal in all that their windows can reach are folded
into one, however many there are; if there were several, all their windows repeat. Where a
grain has different surroundings, one of each kind is sorted, to the right as suffixes and to
the left as reversed prefixes, and the common lengths of neighbours tell which windows repeat.

Grains are spread over tasks by hash. A grain with more than ``max_kinds`` kinds of surroundings
is not sorted in one task: each of its windows is counted by its hash instead, which gives the
same.

Equal texts are folded first; they repeat whole if they are as long as a window. A grain only brings
anchors together; what surrounds them is compared byte by byte, or, where equal surroundings are
folded, by XXH3 of 128 bits; equal texts are folded by two hashes of 64 bits.

* Null texts are empty. Rows with equal or null ids are documents of their own, and repeated rows
  get equal results. Ties do not arise: a window repeats or not, wherever its copies are.
* Long texts are searched in pieces of ``PIECE`` places that overlap by two windows; a task holds one
  text and some 60 bytes for each byte of a piece.
* Empty tables give no rows. Only key and text are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from linkloom.llm.batches import map_texts, parts
from linkloom.llm.deep_shallow import blind_trie, shallow_groups
from linkloom.llm.store import Store, ship

GRAIN = 64
# Some 30 MB of bytes in one task.
MAX_KINDS = 65_536
# Places of a text that are searched at once.
PIECE = 1 << 17
_PAIRED = 16

_CODES = np.random.default_rng(77).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(step: int, n: int) -> np.ndarray:
    out = np.full(n, step, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (least or greatest) over every run of ``width`` values, by doubling."""
    size = 1
    while 2 * size <= width:
        x, size = pick(x[:-size], x[size:]), 2 * size
    return pick(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def pieces(texts: list[bytes], length: int, grain: int, size: int) -> Iterator[tuple[int, int, int, int]]:
    """Texts as slices: index, first byte, and the first place and the one after the last that are
    decided in it. A place needs the windows that hold it, and its surroundings."""
    width = length - grain + 1
    for i, text in enumerate(texts):
        for first in range(0, max(1, len(text)), size):
            yield i, max(0, first - (width - 1)), first, min(len(text), first + size)


class Anchors:
    """The anchors of some texts: ``text`` (its index), ``at``, ``grain`` and ``around``."""

    def __init__(self, texts: list[bytes], length: int, grain: int, size: int = PIECE):
        made = []
        held, begun, total = [], [], 0
        for i, start, first, after in pieces(texts, length, grain, size):
            held.append((i, start, first, after, texts[i][start : after - 1 + length]))
            total += len(held[-1][4])
            if total >= size:
                made.append(self._found(held, length, grain))
                held, total = [], 0
        if held:
            made.append(self._found(held, length, grain))
        self.text, self.at, self.grain = (
            np.concatenate([m[k] for m in made]) if made else np.zeros(0, np.int64) for k in range(3)
        )
        self.around = [x for m in made for x in m[3]]

    @staticmethod
    def _found(held: list[tuple], length: int, grain: int) -> tuple:
        texts = [h[4] for h in held]
        joined = b"".join(texts)
        data = np.frombuffer(joined, np.uint8)
        n, width = len(data), length - grain + 1
        none = np.zeros(0, np.int64)
        if n < length:
            return none, none, none, []
        ends = np.cumsum([len(t) for t in texts])
        starts = np.concatenate(([0], ends[:-1]))
        total = np.concatenate((
            np.zeros(1, np.uint64), np.cumsum(_CODES[data] * _powers(_STEP, n), dtype=np.uint64)
        ))
        back = _powers(_BACK, n)
        grains = _mix((total[grain:] - total[:-grain]) * back[: n - grain + 1]) | np.uint64(1)
        least = _sliding(grains, width, np.minimum)
        # Windows that run over the end of a text count for nothing.
        owner = np.repeat(np.arange(len(texts)), ends - starts)
        least[owner[: n - length + 1] != owner[length - 1 :]] = 0
        edge = np.zeros(width - 1, np.uint64)
        reach = _sliding(np.concatenate((edge, least, edge)), width, np.maximum)
        place = np.flatnonzero(reach == grains)
        piece = owner[place]
        index, start, first, after = (np.array([h[k] for h in held])[piece] for k in range(4))
        at = place - starts[piece] + start
        # Places in the overlap belong to another piece.
        mine = (at >= first) & (at < after)
        place, piece, index, at = place[mine], piece[mine], index[mine], at[mine]
        left = np.maximum(starts[piece], place - (width - 1))
        right = np.minimum(ends[piece], place + length)
        digest = xxhash.xxh3_128_digest
        around = [
            digest(joined[a:b] + (p - a).to_bytes(4) + (b - p).to_bytes(4))
            for a, p, b in zip(left.tolist(), place.tolist(), right.tolist(), strict=True)
        ]
        return index, at, grains[place].view(np.int64), around


def _hash(text: Column) -> list[Column]:
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("h1"), F.xxhash64(F.lit(1), whole).alias("h2")]


def _texts(docs: DataFrame, text: str, store: Store) -> DataFrame:
    """Each different text once, compressed, with its number of copies."""
    def pack(batch: list[bytes]) -> dict[str, list]:
        packer = zstandard.ZstdCompressor(level=1)
        return {"packed": [packer.compress(t) for t in batch], "n_bytes": [len(t) for t in batch]}

    hashed = docs.select(F.col(f"`{text}`").alias("text"), *_hash(F.col(f"`{text}`")))
    packed = map_texts(hashed, "text", ["h1", "h2"], "packed binary, n_bytes long", pack)
    once = packed.groupBy("h1", "h2").agg(
        F.first("packed").alias("packed"), F.first("n_bytes").alias("n_bytes"),
        F.count("*").alias("copies"),
    )
    return store.put("texts", once)


def _unpack(batch: pa.RecordBatch) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(x) for x in batch.column("packed").to_pylist()]


def _anchors(texts: DataFrame, length: int, grain: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, batch.column("n_bytes")):
                h1, h2 = (part.column(c).to_numpy() for c in ("h1", "h2"))
                made = Anchors(_unpack(part), length, grain)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made.grain), pa.array(made.around, pa.binary()),
                     *[pa.array(x) for x in (h1[made.text], h2[made.text], made.at)]],
                    ["grain", "around", "h1", "h2", "at"],
                )

    long = texts.where(F.col("n_bytes") >= length).select("h1", "h2", "packed", "n_bytes")
    return long.mapInArrow(run, "grain long, around binary, h1 long, h2 long, at long")


def repeats(left: list[bytes], right: list[bytes], rows: list[int], length: int, width: int) -> dict[int, list[tuple[int, int]]]:
    """For each of ``rows``, anchors with one grain, which windows occur at another one too.

    ``left`` is reversed. A window is named by how many bytes of it lie left of the anchor; the
    result has ranges of such numbers, both ends included, for the rows that have any.
    """
    by_right, common_right = blind_trie(right, rows)
    by_left, common_left = blind_trie(left, rows)
    found: dict[int, list[tuple[int, int]]] = {}
    if len(rows) <= _PAIRED:
        place = {row: i for i, row in enumerate(by_left)}
        for i, a in enumerate(by_right):
            ahead = length
            for j in range(i + 1, len(rows)):
                ahead = min(ahead, common_right[j])
                p, q = sorted((place[a], place[by_right[j]]))
                low, high = length - ahead, min(width - 1, *common_left[p + 1 : q + 1])
                if low <= high:
                    found.setdefault(a, []).append((low, high))
                    found.setdefault(by_right[j], []).append((low, high))
        return found
    number = {row: i for i, row in enumerate(rows)}
    r_order = np.array([number[r] for r in by_right])
    l_order = np.array([number[r] for r in by_left])
    r_common, l_common = np.array(common_right), np.array(common_left)
    n = len(rows)
    r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
    before = np.zeros(n, bool)
    opened = np.zeros(n, np.int64)
    for d in range(width + 1):
        again = np.zeros(n, bool)
        if d < width:
            # Anchors in one class agree in d bytes to the left and the rest to the right.
            r_class[r_order] = np.cumsum(r_common < length - d)
            l_class[l_order] = np.cumsum(l_common < d)
            _, kind, count = np.unique(r_class * (n + 1) + l_class, return_inverse=True, return_counts=True)
            again = count[kind] > 1
        opened[again & ~before] = d
        for i in np.flatnonzero(before & ~again):
            found.setdefault(rows[i], []).append((int(opened[i]), d - 1))
        before = again
    return found


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same numbers in as few ranges as possible."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], high)
        else:
            out.append((low, high))
    return out


def _surroundings(wanted: DataFrame, texts: DataFrame, length: int, grain: int) -> DataFrame:
    """The bytes around chosen anchors: reversed to the left, as a suffix to the right."""
    asked = wanted.groupBy("h1", "h2").agg(
        F.collect_list(F.struct("grain", "around", "at", "crowded")).alias("asked")
    )
    width = length - grain + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["grain", "around", "crowded", "left", "right"]
        for batch in batches:
            for part in parts(batch, batch.column("n_bytes")):
                rows = []
                for text, asks in zip(_unpack(part), part.column("asked").to_pylist(), strict=True):
                    for a in asks:
                        p = a["at"]
                        before = text[max(0, p - width + 1) : p][::-1]
                        rows.append((a["grain"], a["around"], a["crowded"], before, text[p : p + length]))
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = [pa.int64(), pa.binary(), pa.bool_(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
                )

    joined = texts.join(asked, ["h1", "h2"]).select("packed", "n_bytes", "asked")
    return joined.mapInArrow(
        run, "grain long, around binary, crowded boolean, left binary, right binary"
    )


_RANGES = "grain long, around binary, low int, high int"


def _sorted_ranges(around: DataFrame, length: int, grain: int) -> DataFrame:
    """Ranges of repeated windows for the anchors of grains that fit into one task."""
    width = length - grain + 1

    def settle(rows: list[dict]) -> pa.RecordBatch:
        left, right = [r["left"] for r in rows], [r["right"] for r in rows]
        made = []
        for group in shallow_groups(right, grain):
            if len(group) > 1:
                for row, ranges in repeats(left, right, group, length, width).items():
                    made += [(rows[row]["grain"], rows[row]["around"], *r) for r in merged(ranges)]
        columns = list(zip(*made, strict=True)) or [[]] * 4
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["grain", "around", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                # Whole grains, some thousand rows at a time.
                if len(held) >= 8192 and row["grain"] != held[-1]["grain"]:
                    yield settle(held)
                    held = []
                held.append(row)
        if held:
            yield settle(held)

    dealt = around.repartition("grain").sortWithinPartitions("grain")
    return dealt.mapInArrow(run, _RANGES)


def _counted_ranges(around: DataFrame, length: int, grain: int, store: Store) -> DataFrame:
    """The same for crowded grains: each window is a row, and is counted by its hash."""
    width = length - grain + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["window", "grain", "around", "d"]
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = []
                for r in batch.slice(at, 64).to_pylist():
                    whole, n = r["left"][::-1] + r["right"], len(r["left"])
                    for d in range(max(0, length - len(r["right"])), min(n, width - 1) + 1):
                        window = whole[n - d : n - d + length]
                        rows.append((xxhash.xxh3_128_digest(window), r["grain"], r["around"], d))
                columns = list(zip(*rows, strict=True)) or [[]] * 4
                kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
                )

    windows = around.select("grain", "around", "left", "right").mapInArrow(
        run, "window binary, grain long, around binary, d int"
    )
    # A place has one kind of surroundings per grain, so equal rows are different places.
    same = ["window", "grain", "d"]
    windows = store.put("windows", windows)
    again = windows.groupBy(*same).agg(F.count("*").alias("n")).where("n > 1")
    again = store.put("again", again.select(*same))
    return windows.join(again, same).select(
        "grain", "around", F.col("d").alias("low"), F.col("d").alias("high")
    )


def without_repeats(
    docs: DataFrame, length: int = 200, text: str = "text", grain: int = GRAIN,
    max_kinds: int = MAX_KINDS,
) -> DataFrame:
    """For every different text, named by ``h1`` and ``h2``: ``n_bytes``, ``spans`` (``first``
    byte and ``end`` of each maximal run of removed bytes) and ``kept``, the bytes left."""
    store = Store(docs.sparkSession)
    ship(docs.sparkSession)
    grain = min(grain, length)
    width = length - grain + 1
    texts = _texts(docs, text, store)

    anchors = _anchors(texts, length, grain)
    often = anchors.groupBy("grain").agg(F.count("*").alias("n")).where("n > 1").select("grain")
    often = store.put("often", often)
    found = store.put("found", anchors.join(often, "grain"))
    kinds = store.put("kinds", found.groupBy("grain", "around").agg(
        F.count("*").alias("n"), F.min(F.struct("h1", "h2", "at")).alias("one")
    ))
    # Written, so that the join below may split the rows of a crowded grain.
    mixed = store.put(
        "mixed", kinds.groupBy("grain").agg(F.count("*").alias("kinds")).where("kinds > 1")
    )
    wanted = kinds.join(mixed, "grain").select(
        "grain", "around", "one.*", (F.col("kinds") > max_kinds).alias("crowded")
    )
    around = store.put("around", _surroundings(wanted, texts, length, grain))
    ranges = _sorted_ranges(around.where("NOT crowded"), length, grain).unionByName(
        _counted_ranges(around.where("crowded"), length, grain, store)
    )
    # All windows of anchors that occur twice with all their surroundings repeat.
    whole = kinds.where("n > 1").select(
        "grain", "around", F.lit(0).alias("low"), F.lit(width - 1).alias("high")
    )
    ranges = store.put("ranges", ranges.unionByName(whole))
    spans = found.join(ranges, ["grain", "around"]).select(
        "h1", "h2", F.struct(
            (F.col("at") - F.col("high")).alias("low"), (F.col("at") - F.col("low")).alias("high")
        ).alias("s"),
    )
    spans = store.put("spans", spans.groupBy("h1", "h2").agg(F.collect_list("s").alias("starts")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        names = ["h1", "h2", "n_bytes", "spans", "kept"]
        for batch in batches:
            for part in parts(batch, batch.column("n_bytes")):
                removed, kept = [], []
                starts = part.column("starts")
                low, high = (starts.flatten().field(k).to_numpy() for k in ("low", "high"))
                ends = np.cumsum(starts.value_lengths().fill_null(0).to_numpy())
                for data, copies, a, b in zip(
                    _unpack(part), part.column("copies").to_pylist(),
                    [0, *ends[:-1].tolist()], ends.tolist(), strict=True,
                ):
                    gone = removed_spans(len(data), copies, low[a:b], high[a:b], length)
                    removed.append([{"first": x, "end": y} for x, y in gone])
                    edges = [0, *[x for span in gone for x in span], len(data)]
                    pairs = zip(edges[::2], edges[1::2], strict=True)
                    kept.append(b"".join(data[a:b] for a, b in pairs))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names[:3]], pa.array(removed, kind), pa.array(kept, pa.binary())],
                    names,
                )

    joined = texts.join(spans, ["h1", "h2"], "left").select(
        "h1", "h2", "n_bytes", "packed", "copies", "starts"
    )
    return joined.mapInArrow(
        cut, "h1 long, h2 long, n_bytes long, spans array<struct<first:long,end:long>>, kept binary"
    )


def removed_spans(
    n: int, copies: int, low: np.ndarray, high: np.ndarray, length: int
) -> list[tuple[int, int]]:
    """Maximal runs of bytes in repeated windows, whose starts come as ranges."""
    if n < length:
        return []
    if copies > 1:
        return [(0, n)]
    low, high = np.maximum(low, 0), np.minimum(high, n - length)
    low, high = low[low <= high], high[low <= high]
    if not len(low):
        return []
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order] + length)
    first = np.flatnonzero(np.append(True, low[1:] > reach[:-1]))
    last = np.append(first[1:], len(low)) - 1
    return list(zip(low[first].tolist(), reach[last].tolist(), strict=True))


def for_documents(docs: DataFrame, made: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the columns of ``made`` for each document."""
    ids = docs.select(F.col(f"`{key}`").alias(key), *_hash(F.col(f"`{text}`")))
    return ids.join(made, ["h1", "h2"]).drop("h1", "h2")
