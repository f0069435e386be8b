"""The trie of all conversation prefixes, with figures for every subtree.

Conversations become paths of turn digests. A sample of paths gives splitters, which range-partition
all paths (and ids, so that copies of one path may lie in many shards). The trie of the splitters'
paths is the skeleton and is broadcast: a node whose members lie in two shards is a prefix of the
splitter between them, hence in the skeleton. Each task walks its sorted shard once and finishes all
other nodes; of skeleton nodes it gives partial figures, which are summed by node and then from the
leaves of the skeleton up. The skeleton has at most one node for each turn of each splitter, that is
``shards`` times the turns of one conversation, whatever the number of conversations.

* Rows without ``conv_id`` belong to no conversation and are left out. Null roles and texts are empty.
* Turns are ordered by ``turn``, null first; ties, and repeated rows, which all stay, by role and text.
* A conversation is one row of 16 bytes and a number per turn, so it may have some 100 million turns.
  Texts never leave their rows but as digests (half of a SHA-256) and lengths, however long they are.
* Conversations without turns are members of the root. An empty table has no nodes, not even a root.
* Columns other than the four named are not read, so their names may be any.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from linkloom.llm.store import Store, ship

WIDTH = 16  # bytes of a digest
SAMPLED = 20  # paths in the sample, for each shard
MAX_PENDING = 5_000  # children kept until their parent is finished
CHUNK = 1 << 16  # bytes of ids that a shard hands on at once
_ROWS = 10_000
_NONE = hashlib.sha256().hexdigest()

_NODE, _ORPHAN, _PARTIAL, _ENDS = range(4)
_OUT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, digest string"
)
_WALKED = (
    "kind int, key long, parent_key long, part long, place long, last_bytes long, ids binary, " + _OUT
)


# -- conversations as paths

def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``digest`` (hexadecimal) and ``n_bytes``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"),
    )
    apart = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return named.withColumns({
        "digest": F.substring(F.sha2(apart, 256), 1, 2 * WIDTH),
        "n_bytes": F.octet_length("text").cast("long"),
    })


def _listed(rows: DataFrame, place: str) -> DataFrame:
    """One row per conversation: its turns by ``place``, null first."""
    turn = F.struct(F.col(place).cast("long").alias("place"), "digest", "n_bytes")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def gather(conversations: DataFrame, store: Store) -> DataFrame:
    """``conv_id`` and ``turns``, an array of digests and lengths in order.

    Only conversations in which a turn number is repeated are sorted by texts.
    """
    rows = turns(conversations)
    listed = store.put("listed", _listed(rows.drop("role", "text"), "turn"))
    numbers = F.transform("turns", lambda t: t["place"])
    tied = F.size(F.array_distinct(numbers)) < F.size("turns")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    # Written, so that the size is known to the join: few or no ties move few or no texts.
    ids = store.put("tied", listed.where(tied).select("conv_id"))
    unsure = rows.join(ids, "conv_id", "left_semi")
    ranked = unsure.withColumn("_place", F.row_number().over(order))
    return listed.where(~tied).unionByName(_listed(ranked, "_place"))


def with_shared_heads(gathered: DataFrame, head: Column, group: Column, most: int) -> DataFrame:
    """Conversations that begin with the first ``head`` turns of conversation ``group``, where there
    is one, followed by their own turns after that many. ``head`` is at most ``most``."""
    heads = gathered.select(
        F.col("conv_id").alias("_group"), F.slice("turns", 1, most).alias("_head")
    )
    lent = gathered.withColumns({"_n": head.cast("int"), "_of": group}).join(
        heads.where(F.col("_group").isNotNull()), F.col("_of") == F.col("_group"), "left"
    )
    first = F.when(
        F.col("_head").isNotNull() & (F.col("_n") > 0), F.slice("_head", F.lit(1), F.col("_n"))
    ).otherwise(F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("_n") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return lent.select("conv_id", F.concat(first, rest).alias("turns"))


# -- shards

@dataclass
class Skeleton:
    """The trie of the splitters' paths. Node 0 is the root; parents come before children."""

    splitters: list[tuple[bytes, int]]
    child: dict[tuple[int, bytes], int] = field(default_factory=dict)
    parent: list[int] = field(default_factory=lambda: [-1])

    def __post_init__(self) -> None:
        for path, _ in self.splitters:
            node = 0
            for at in range(0, len(path), WIDTH):
                step = (node, path[at : at + WIDTH])
                if step not in self.child:
                    self.child[step] = len(self.parent)
                    self.parent.append(node)
                node = self.child[step]


def _skeleton(paths: DataFrame, shards: int) -> Skeleton:
    sample = sorted(
        (bytes(r["path"]), r["conv_id"])
        for r in paths.orderBy(F.xxhash64("conv_id"), "conv_id").limit(SAMPLED * shards)
        .select("path", "conv_id").collect()
    )
    places = np.linspace(0, len(sample), shards + 1)[1:-1].astype(int)
    return Skeleton(sorted({sample[i] for i in places if i < len(sample)}))


class _Open:
    """A node on the way from the root to the current path."""

    __slots__ = (
        "step", "depth", "size", "bone", "least", "convs", "children", "leaves", "saved",
        "ends", "ids", "n_ids", "sent", "pending", "key",
    )

    def __init__(self, step: bytes, depth: int, size: int, bone: int | None):
        self.step, self.depth, self.size, self.bone = step, depth, size, bone
        self.least, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.ids, self.n_ids, self.sent = None, [], 0, 0
        self.pending, self.key = [], None

    def take(self, least: int, convs: int) -> None:
        self.least = least if self.least is None else min(least, self.least)
        self.convs += convs

    def figures(self, over: int | None) -> tuple:
        """The columns of a node, but for those before ``conv_id``."""
        ends = self.ends.hexdigest() if self.ends else _NONE
        return (
            self.least, self.depth, over, self.convs, self.children, self.leaves, self.saved,
            ends, self.step.hex() or None,
        )


class _Walk:
    """One pass over a sorted shard; ``rows`` collects what is finished."""

    def __init__(self, skeleton: Skeleton, part: int):
        self.skeleton, self.part = skeleton, part
        self.rows: list[tuple] = []
        self.stack = [_Open(b"", 0, 0, 0)]
        self.keys = 0

    def add(self, path: bytes, sizes: list[int], conv_id: int) -> None:
        same, most = 0, min(len(self.stack) - 1, len(sizes))
        while same < most and path[same * WIDTH : (same + 1) * WIDTH] == self.stack[same + 1].step:
            same += 1
        while len(self.stack) > same + 1:
            self.close()
        for d in range(same, len(sizes)):
            self.open(path[d * WIDTH : (d + 1) * WIDTH], sizes[d])
        end = self.stack[-1]
        end.take(conv_id, 1)
        name = str(conv_id).encode()
        if end.bone is not None:
            end.ids.append(name)
            end.n_ids += len(name) + 1
            if end.n_ids >= CHUNK:
                self.send(end)
        elif end.ends is None:
            end.ends = hashlib.sha256(name)
        else:
            end.ends.update(b"," + name)

    def open(self, step: bytes, size: int) -> None:
        over = self.stack[-1]
        bone = None if over.bone is None else self.skeleton.child.get((over.bone, step))
        if bone is None:
            over.children += 1
        self.stack.append(_Open(step, over.depth + 1, size, bone))

    def send(self, node: _Open) -> None:
        """Hand on the ids of conversations that end at a skeleton node."""
        if node.ids:
            ids = b",".join(node.ids)
            self.rows.append((_ENDS, -1 - node.bone, None, self.part, node.sent, None, ids, *_EMPTY))
            node.sent += 1
            node.ids, node.n_ids = [], 0

    def release(self, node: _Open) -> None:
        """Let children go before their parent is finished; they are joined with it later."""
        if node.key is None:
            self.keys += 1
            node.key = (self.part << 40) + self.keys if node.bone is None else -1 - node.bone
        for child in node.pending:
            self.rows.append((_ORPHAN, child.key, node.key, *[None] * 4, *child.figures(None)))
        node.pending = []

    def close(self) -> None:
        node = self.stack.pop()
        if node.bone is not None:
            self.release(node)
            self.send(node)
            self.rows.append(
                (_PARTIAL, node.key, None, None, None, node.size, None, *node.figures(None))
            )
            return
        node.leaves = node.leaves or 1
        node.saved += (node.convs - 1) * node.size
        for child in node.pending:
            self.rows.append((_NODE, child.key, *[None] * 5, *child.figures(node.least)))
        node.pending = []
        over = self.stack[-1]
        over.take(node.least, node.convs)
        over.leaves += node.leaves
        over.saved += node.saved
        over.pending.append(node)
        if len(over.pending) >= (MAX_PENDING if over.bone is None else 1):
            self.release(over)

    def end(self) -> None:
        while self.stack:
            self.close()


_EMPTY = [None] * 9


def _walked(paths: DataFrame, skeleton: Skeleton, shards: int) -> DataFrame:
    """Finished nodes, nodes that wait for their parent, and the figures of skeleton nodes."""
    ship(paths.sparkSession)
    known = paths.sparkSession.sparkContext.broadcast(skeleton)
    dealt = StructType([StructField("part", LongType()), *paths.schema.fields])
    schema = StructType.fromDDL(_WALKED)
    arrow = to_arrow_schema(schema)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            parts = [bisect_right(known.value.splitters, key) for key in keys]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), *batch.columns], dealt.names)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
        )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Walk | None = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "path", "sizes", "conv_id")]
            for part, path, sizes, conv_id in zip(*columns, strict=True):
                if now is None or now.part != part:
                    if now:
                        now.end()
                        yield made(now.rows)
                    now = _Walk(known.value, part)
                now.add(path, sizes, conv_id)
                if len(now.rows) >= _ROWS:
                    yield made(now.rows)
                    now.rows = []
        if now:
            now.end()
            yield made(now.rows)

    shard = paths.mapInArrow(deal, dealt).repartitionById(shards, F.col("part").cast("int"))
    return shard.sortWithinPartitions("part", "path", "conv_id").mapInArrow(walk, schema)


# -- what the shards share

def _combined(walked: DataFrame, skeleton: Skeleton) -> list[tuple]:
    """``key`` and the columns of each skeleton node but for ``ends_sha256``: partial figures
    summed by node, then children added to their parents."""
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    parts = walked.where(F.col("kind") == _PARTIAL).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in sums], F.max("last_bytes").alias("last_bytes"),
        F.max("digest").alias("digest"),
    )
    nodes = {-1 - r["key"]: r.asDict() for r in parts.collect()}
    for bone in sorted(nodes, reverse=True):
        node = nodes[bone]
        node["n_leaves"] = node["n_leaves"] or 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["last_bytes"]
        if bone:
            over = nodes[skeleton.parent[bone]]
            known = [x["conv_id"] for x in (over, node) if x["conv_id"] is not None]
            over["conv_id"] = min(known)
            over["n_children"] += 1
            for c in ("n_convs", "n_leaves", "saved_tokens"):
                over[c] += node[c]
    return [
        (
            -1 - bone, n["conv_id"], n["depth"],
            nodes[skeleton.parent[bone]]["conv_id"] if bone else None,
            *[n[c] for c in sums], n["digest"],
        )
        for bone, n in nodes.items()
    ]


def _ends(walked: DataFrame) -> DataFrame:
    """``key`` and ``ends_sha256``: the digest of a skeleton node's ids, read in order of shards.

    The digest of one list can only be made from its first byte to its last; the lists come
    here as pieces of ``CHUNK`` bytes, and a task holds one piece at a time.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hashed = None, None
        for batch in batches:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids"), strict=True):
                if key != now:
                    if hashed:
                        yield pa.RecordBatch.from_pydict({"key": [now], "ends_sha256": [hashed.hexdigest()]})
                    now, hashed = key, hashlib.sha256(ids.as_buffer())
                else:
                    hashed.update(b",")
                    hashed.update(ids.as_buffer())
        if hashed:
            yield pa.RecordBatch.from_pydict({"key": [now], "ends_sha256": [hashed.hexdigest()]})

    pieces = walked.where(F.col("kind") == _ENDS).select("key", "part", "place", "ids")
    inorder = pieces.repartition("key").sortWithinPartitions("key", "part", "place")
    return inorder.select("key", "ids").mapInArrow(digest, "key long, ends_sha256 string")


def nodes(gathered: DataFrame, store: Store, shards: int | None = None) -> DataFrame:
    """Every node of the trie of ``gathered`` (``conv_id``, ``turns``), the root included.

    ``conv_id`` is the smallest member, ``digest`` that of the last turn (see :func:`turns`).
    """
    spark = gathered.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = store.put("paths", gathered.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["n_bytes"]).alias("sizes"),
    ))
    skeleton = _skeleton(paths, shards)
    walked = store.put("walked", _walked(paths, skeleton, shards))
    names = StructType.fromDDL(_OUT).names
    bare = [f"{f.name} {f.dataType.simpleString()}" for f in StructType.fromDDL(_OUT)
            if f.name != "ends_sha256"]
    bones = spark.createDataFrame(
        [r for r in _combined(walked, skeleton) if r[1] is not None],
        "key long, " + ", ".join(bare),
    )
    finished = walked.where(F.col("kind") == _NODE)
    orphans = walked.where(F.col("kind") == _ORPHAN).drop("parent_conv_id")

    def adopted(children: DataFrame, parents: DataFrame) -> DataFrame:
        over = parents.select(
            F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")
        )
        return children.join(over, "parent_key").select(*names)

    # Not more rows than the skeleton has nodes.
    under_bones = adopted(orphans.where("parent_key < 0"), F.broadcast(bones))
    local = walked.where(F.col("kind").isin(_NODE, _ORPHAN) & F.col("key").isNotNull())
    under_local = adopted(orphans.where("parent_key > 0"), local)
    ended = bones.join(_ends(walked), "key", "left")
    return finished.select(*names).unionByName(under_bones).unionByName(under_local).unionByName(
        ended.fillna(_NONE, ["ends_sha256"]).select(*names)
    )
