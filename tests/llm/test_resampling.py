from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from compare import assert_same, duck
from hard_texts import MIDDLE, SMALL
from pyspark.sql import functions as F

from linkloom.llm import queries, resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def runs(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, n=1, size=10_000, percent=10, least=20):
    def hashed(text):
        return [zlib.crc32(f.encode()) % size for f in runs(text, n)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(hashed(text))
    for text in target:
        t.update(hashed(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + size) / ((s[b] + 1) * (all_t + size))))
        for b in range(size)
    ]
    rows = []
    for key, text in docs:
        found = [gain[b] for b in hashed(text)]
        weight = sum(found) // len(found) if found else 0
        name = f"{2024}:{'' if key is None else key}".encode()
        h = int(hashlib.sha256(name).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None, len(runs(text, 1))])
    able = [r for r in rows if r[5] >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = i + 1
    return Counter(tuple(r[:5]) for r in rows)


def got(frame):
    return Counter(tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect())


def pairs(frame):
    return [tuple(r) for r in frame.select("doc_id", "text").collect()]


@pytest.mark.parametrize("n,size,percent,least", [(1, 10_000, 10, 20), (3, 500, 60, 1), (2, 65_536, 100, 0)])
def test_hard_texts(spark, hard_docs, n, size, percent, least):
    target = spark.createDataFrame([("the same line",), (None,), ("Émile Ünder 42",)], "text string")
    frame = resampling.resample(
        hard_docs, target, percent, least, resampling.Features(n, size)
    )
    want = brute(pairs(hard_docs), ["the same line", None, "Émile Ünder 42"], n, size, percent, least)
    assert got(frame) == want


def test_pieces_change_nothing(monkeypatch):
    text = " ".join(f"Wörd{i % 50}." for i in range(4000)).encode()
    whole = resampling.Features(3, 1000).of(text)
    monkeypatch.setattr(resampling, "_PIECE", 37)
    cut = resampling.Features(3, 1000).of(text)
    assert whole[0] == cut[0]
    assert sorted(memoryview(whole[1]).cast("H")) == sorted(memoryview(cut[1]).cast("H"))


@pytest.mark.parametrize("spread", [0.0, 1e-9, 0.01, 1.0])
def test_one_id_with_a_third_of_all_rows(spark, spread):
    """Rows equal in id and score are told apart; a bracket that misses the cutoff is widened."""
    rows = [(7 if i % 3 == 0 else i % 90, f"{'same words ' * 10} {i % 4}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("same words",)], "text string")
    frame = resampling.resample(docs, target, 40, 20, spread=spread)
    assert got(frame) == brute(rows, ["same words"], percent=40)


def test_empty_tables(spark, hard_docs, no_docs):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(no_docs, none, 10, 20).collect() == []
    assert got(resampling.resample(hard_docs, none, 50, 1)) == brute(pairs(hard_docs), [], percent=50, least=1)


def test_too_few_to_draw(spark):
    docs = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    frame = resampling.resample(docs, docs.select("text"), 10, 20)
    assert frame.where(F.col("rank").isNotNull()).count() == 0


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_query(spark, folder):
    name = "op12_resample"
    assert assert_same(queries.QUERIES[name](spark, folder), duck(folder), queries.ORACLE_SQL[name]) > 0


def test_query_equals_brute_force(spark):
    docs = pairs(spark.read.parquet(f"{SMALL}/documents.parquet"))
    target = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert got(queries.op12_resample(spark, SMALL)) == brute(docs, target)
