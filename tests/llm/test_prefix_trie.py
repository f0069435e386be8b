from __future__ import annotations

import hashlib
import math
import random
import zlib

import pytest
from compare import assert_same, duck
from hard_texts import MIDDLE, SMALL
from pyspark.sql import functions as F

from linkloom.llm import prefix_trie, queries
from linkloom.llm.store import Store

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def rebuilt(rows):
    """The conversations of the contract, as lists of (role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    return out


def brute(convs):
    if not convs:
        return []
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]
        inner = {p[:-1] for p in below if p}
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(path))
        out.append((
            min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids),
            sum(1 for p in below if len(p) == len(path) + 1),
            sum(1 for p in below if p not in inner),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def key(row):
    return tuple((x is None, x) for x in row)


def made(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=key)


def convs_of(rows):
    got = {}
    for c, turn, role, text in rows:
        got.setdefault(c, []).append((turn, role, text))
    return {c: [t[1:] for t in sorted(x)] for c, x in got.items()}


HARD = [
    (0, 0, "user", "hello"), (0, 1, "bot", "ééé"), (0, 1, None, None), (0, None, "system", ""),
    (1, 0, "user", "hello"), (1, 0, "user", "hello"), (1, 3, "a", "b" * 100_000), (2, 5, "x", None),
    (3, None, None, None), (7, 1, "user", "alone"), (-3, 0, "user", "below"), (-5, 0, "user", "hello"),
    (None, 0, "user", "nobody"), (9, 1, "us", "er"), (10, 1, "u", "ser"), (10, 2, "z", "z"),
    *[(4, i, "user", f"turn {i}") for i in range(40)], *[(5, i, "user", f"turn {i}") for i in range(40)],
]


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_equals_brute_force_on_hard_rows(spark, shards):
    store = Store(spark)
    rows = table(spark, HARD).withColumns({"_place": F.lit(1), "key": F.lit(2), "_n": F.lit(3)})
    gathered = prefix_trie.gather(rows, store)
    convs = prefix_trie.with_shared_heads(
        gathered, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9,
        F.col("conv_id") - F.col("conv_id") % 5, 8,
    )
    assert made(prefix_trie.nodes(convs, store, shards)) == sorted(brute(rebuilt(HARD)), key=key)


@pytest.mark.parametrize("pending", [1, 3, 5_000])
def test_wide_deep_and_copied(spark, monkeypatch, pending):
    """A node with many children, one deep conversation, and one path of a third of all rows."""
    monkeypatch.setattr(prefix_trie, "MAX_PENDING", pending)
    monkeypatch.setattr(prefix_trie, "CHUNK", 20)
    draw = random.Random(pending)
    rows = [(i, 0, "user", "common") for i in range(300)]
    rows += [(i, 1, "bot", "the same") for i in range(100)]
    rows += [(i, 1, "bot", f"other {i}") for i in range(100, 200)]
    rows += [(i, 2, "user", draw.choice("abc")) for i in range(60, 200)]
    rows += [(999, i, "user", "again") for i in range(300)]
    store = Store(spark)
    got = prefix_trie.nodes(prefix_trie.gather(table(spark, rows), store), store, 7)
    assert made(got) == sorted(brute(convs_of(rows)), key=key)


def test_empty_and_turnless(spark):
    store = Store(spark)
    none = prefix_trie.gather(table(spark, []), store)
    assert prefix_trie.nodes(none, store).collect() == []
    # Conversation 6 lends all its turns from conversation 5, which is not there.
    rows = [(6, 0, "user", "gone")]
    assert zlib.crc32(b"6") % 9 >= 1
    gathered = prefix_trie.gather(table(spark, rows), Store(spark))
    lent = prefix_trie.with_shared_heads(gathered, F.lit(1), F.lit(5), 8)
    root = [(6, 0, None, 1, 0, 1, 0, hashlib.sha256(b"6").hexdigest())]
    assert made(prefix_trie.nodes(lent, Store(spark))) == root


def test_turns_lead_back_to_texts(spark):
    found = prefix_trie.turns(table(spark, HARD)).select("digest", "role", "text").distinct()
    assert found.count() == found.select("digest").distinct().count()
    assert found.where("length(digest) = 32").count() == found.count()


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_query(spark, folder):
    name = "op11_prefix_trie"
    assert assert_same(queries.QUERIES[name](spark, folder), duck(folder), queries.ORACLE_SQL[name]) > 0


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MIDDLE}/conversations.parquet").collect()]
    got = queries.op11_prefix_trie(spark, MIDDLE)
    assert made(got) == sorted(brute(rebuilt(rows)), key=key)
