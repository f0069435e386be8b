from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from hard_texts import SMALL
from pyspark.sql import functions as F

from linkloom.llm import queries, suffix_dedup
from linkloom.llm.deep_shallow import blind_trie, shallow_groups


def expected(texts: list[str | None], length: int) -> list[tuple]:
    """By counting every window."""
    data = [(t or "").encode() for t in texts]
    windows = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if windows[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(docs, length: int, **options) -> list[tuple]:
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    made = suffix_dedup.without_repeats(docs, length, **options).select(
        "h1", "h2", "n_bytes", gone.alias("gone"), F.size("spans").alias("n"), F.sha2("kept", 256).alias("k")
    )
    return [tuple(r)[1:] for r in sorted(suffix_dedup.for_documents(docs, made).collect(), key=lambda r: (r[0] is None, r[0]))]


@pytest.mark.parametrize("options", [
    {"grain": 6}, {"grain": 6, "max_kinds": 3}, {"grain": 20}, {"grain": 2, "max_kinds": 40},
])
def test_equals_counting_every_window(spark, options):
    r = random.Random(9)

    def some(n):
        return "".join(r.choice("abcdefgh é") for _ in range(n))

    base = [some(r.randint(1, 200)) for _ in range(50)]
    texts = list(base)
    for _ in range(100):
        t = some(r.randint(0, 30))
        for _ in range(r.randint(1, 4)):
            b = r.choice(base)
            i = r.randrange(len(b))
            t += b[i : i + r.randint(5, 90)] + some(r.randint(0, 3))
        texts.append(t)
    texts += ["a" * 100, "ab" * 60, "a" * 19, "a" * 20, None, "", "x\0" * 30, "x\0" * 29 + "x\0\0",
              base[3], base[3], "abc" * 50 + "q" + "abc" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert found(docs, 20, **options) == expected(texts, 20)


def test_many_alike_surroundings(spark):
    """One passage in very many places: a group is sorted, or counted beyond its limit."""
    r = random.Random(1)
    passage = "".join(r.choice("abcdefgh") for _ in range(35))
    texts = [f"{i:05d}" + passage[: r.randint(10, 35)] + f"{i * 7:05d}" for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = expected(texts, 20)
    assert found(docs, 20, grain=6) == want
    assert found(docs, 20, grain=6, max_kinds=10) == want


def test_blind_trie_sorts():
    r = random.Random(3)
    for _ in range(200):
        strings = [bytes(r.choice(b"\0ab") for _ in range(r.randint(0, 12))) for _ in range(r.randint(1, 30))]
        order, common = blind_trie(strings, list(range(len(strings))))
        assert [strings[i] for i in order] == sorted(strings)
        for x, y, n in zip(order, order[1:], common[1:], strict=False):
            a, b = strings[x], strings[y]
            assert a[:n] == b[:n] and (a == b and n == len(a) or a[n : n + 1] != b[n : n + 1])


def test_shallow_groups_agree_and_come_in_order():
    r = random.Random(4)
    strings = [bytes(r.choice(b"ab") for _ in range(14)) for _ in range(300)]
    groups = shallow_groups(strings, 10)
    heads = [{strings[i][:10] for i in g} for g in groups]
    assert all(len(h) == 1 for h in heads)
    flat = [h.pop() for h in heads]
    assert flat == sorted(set(s[:10] for s in strings))


def test_hard_documents(hard_docs):
    rows = hard_docs.select("doc_id", "text").collect()
    want = expected([r.text for r in rows], 50)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, want[i]))
    got = found(hard_docs, 50)
    assert sorted(got) == sorted(want[i] for i in order)


def test_no_documents(no_docs):
    assert suffix_dedup.without_repeats(no_docs).count() == 0


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: w for r, w in zip(rows, expected([r.text for r in rows], 200), strict=True)}
    got = queries.op7_suffix_dedup(spark, SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
