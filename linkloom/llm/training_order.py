"""Training-order materialisation: token sequences in a keyed random order, in binary shards.

Texts are encoded once, ended by an end token, and the tokens of each input partition cut into
sequences of equal length; the last of a partition is filled with end tokens. The sequences are
written to a table, counted by partition, and so numbered over all partitions without gaps. A keyed
Feistel network on the smallest even number of bits permutes more numbers than there are, so a number
is sent round again until it falls into the range (cycle-walking). That is the slot of a sequence, and
every slot is taken.

A shard is a file that holds a fixed range of slots, in order. A record is its slot as a 64-bit
number, the ids as 16-bit numbers, all little-endian, and a line feed, which Spark's text writer
adds: slot ``s`` begins at ``s % shard`` times the stride of shard ``s // shard``, so that a reader
goes on from any slot without an index. The size of every shard is checked when all are written.
Writing is committed by Spark, and lost tasks are written again.

* Null and empty texts are an end token alone. Repeated rows are written as often as they occur.
* Long texts are encoded whole; a task holds one text and its tokens.
* Ties do not arise: the key alone decides the order. Empty tables give one empty shard.
* Columns other than the text are not read, so their names may be any.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.llm import byte_tokens
from linkloom.llm.batches import parts
from linkloom.llm.store import Store, ship

_ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round_keys(key: int) -> list[int]:
    seeds = _mix(np.arange(1, _ROUNDS + 1, dtype=np.uint64), key & (2**64 - 1))
    return [int(s) for s in seeds]


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each number below ``n``; a bijection for every key."""
    half = np.uint64(_half_bits(n))
    mask = (np.uint64(1) << half) - np.uint64(1)
    x = np.array(x, np.uint64)
    open_ = np.ones(len(x), bool)
    while open_.any():
        left, right = x[open_] >> half, x[open_] & mask
        for k in _round_keys(key):
            left, right = right, left ^ (_mix(right, k) & mask)
        x[open_] = left << half | right
        open_ = x >= n
    return x.astype(np.int64)


def unpermute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """The number whose slot each is."""
    half = np.uint64(_half_bits(n))
    mask = (np.uint64(1) << half) - np.uint64(1)
    x = np.array(x, np.uint64)
    open_ = np.ones(len(x), bool)
    while open_.any():
        left, right = x[open_] >> half, x[open_] & mask
        for k in reversed(_round_keys(key)):
            left, right = right ^ (_mix(left, k) & mask), left
        x[open_] = left << half | right
        open_ = x >= n
    return x.astype(np.int64)


def _sequences(docs: DataFrame, shared, length: int, text: str, store: Store) -> DataFrame:
    """``part``, ``at`` (from 0 in each part) and ``ids`` of every sequence, as a written table."""
    texts = docs.select(F.col(f"`{text}`").alias("text"), F.spark_partition_id().alias("part"))
    size = 2 * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, held, waiting = None, 0, [], 0
        tokens = byte_tokens.loaded(shared)
        end = np.uint16(tokens.end).tobytes()

        def rows(stream: bytes) -> pa.RecordBatch:
            count = len(stream) // size
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(count, part)), pa.array(np.arange(at, at + count)),
                pa.array([stream[i * size : (i + 1) * size] for i in range(count)], pa.binary()),
            ], ["part", "at", "ids"])

        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            for few in parts(batch, pc.binary_length(batch.column("text"))):
                for string in few.column("text").to_pylist():
                    held.append(tokens.encode(string or "") + end)
                    waiting += len(held[-1])
                if waiting >= 256 * size:
                    stream = b"".join(held)
                    whole = len(stream) // size * size
                    yield rows(stream[:whole])
                    at += whole // size
                    held, waiting = [stream[whole:]], len(stream) - whole
        if stream := b"".join(held):
            yield rows(stream + end * (-len(stream) % size // 2))

    made = texts.mapInArrow(cut, "part long, at long, ids binary")
    return store.put("sequences", made, compression="zstd")


def materialise(
    docs: DataFrame, path: str, ranks: str, pattern: str, key: int,
    length: int = 1024, shard: int = 8192, text: str = "text",
) -> None:
    """Write ``path``/shards and ``path``/manifest."""
    spark = docs.sparkSession
    ship(spark)
    table = _sequences(docs, byte_tokens.share(spark, ranks, pattern), length, text, Store(spark))
    # One number per partition.
    firsts, n = {}, 0
    for row in sorted(table.groupBy("part").agg(F.count("*").alias("rows")).collect()):
        firsts[row["part"]] = n
        n += row["rows"]
    given = spark.sparkContext.broadcast(firsts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = np.array([given.value[p] for p in batch.column("part").to_pylist()], np.int64)
            slots = permute(first + batch.column("at").to_numpy(), n, key)
            made = [
                slot.tobytes() + ids.as_buffer().to_pybytes()
                for slot, ids in zip(slots.astype("<i8"), batch.column("ids"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(made, pa.binary())], ["slot", "record"])

    shards, stride = max(1, -(-n // shard)), 2 * length + 9
    placed = table.mapInArrow(place, "slot long, record binary")
    dealt = placed.repartitionById(shards, F.floor(F.col("slot") / shard).cast("int"))
    (
        dealt.sortWithinPartitions("slot").select(F.col("record").cast("string"))
        .write.mode("overwrite").option("lineSep", "\n").text(f"{path}/shards")
    )
    wrong = _shards(spark, path).where(
        F.col("length") != stride * F.least(F.lit(shard), F.lit(n) - shard * F.col("shard"))
    ).agg(F.count("*")).first()[0]
    there = _shards(spark, path).where("length > 0").count()
    if wrong or there != -(-n // shard):
        raise ValueError(f"{wrong} of {there} shards are not as long as their slots")
    manifest = {
        "numbers": n, "length": length, "stride": stride, "shard": shard, "key": key,
        "rounds": _ROUNDS, "dtype": [["slot", "<i8"], ["ids", "<u2", length], ["end", "u1"]],
    }
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/manifest")


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """``shard``, ``length`` and ``content`` of every shard; the content is read only if it is used."""
    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("long")
    files = spark.read.format("binaryFile").load(f"{path}/shards")
    return files.select(number.alias("shard"), "length", "content")


def read(spark: SparkSession, path: str, first_slot: int = 0) -> DataFrame:
    """``slot``, ``shard``, ``offset`` in the shard, ``sequence`` (its number before the
    permutation) and ``ids`` from ``first_slot`` on. Earlier shards are not opened."""
    ship(spark)
    manifest = json.loads(spark.read.text(f"{path}/manifest").first()[0])
    n, key, stride, shard = (manifest[k] for k in ("numbers", "key", "stride", "shard"))
    files = _shards(spark, path).where(F.col("shard") >= first_slot // shard).select("shard", "content")
    names = ["slot", "shard", "offset", "sequence", "ids"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                number, content = batch.column(0)[row].as_py(), batch.column(1)[row].as_buffer()
                if content.size % stride:
                    raise ValueError(f"shard {number} does not end with a whole record")
                records = np.frombuffer(content, np.dtype([("slot", "<i8"), ("rest", f"V{stride - 8}")]))
                first = max(0, first_slot - number * shard)
                for at in range(first, len(records), 1024):
                    slots = records["slot"][at : at + 1024].astype(np.int64)
                    places = np.arange(at, at + len(slots)) * stride
                    ids = [content.slice(p + 8, stride - 9).to_pybytes() for p in places.tolist()]
                    columns = [slots, np.full(len(slots), number), places, unpermute(slots, n, key)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(ids)], names)

    return files.mapInArrow(cut, "slot long, shard long, offset long, sequence long, ids binary")
