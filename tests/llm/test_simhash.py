from __future__ import annotations

import random

import pytest
import xxhash
from hard_texts import MIDDLE, SMALL

from linkloom.llm import queries, simhash
from linkloom.llm.components import components
from linkloom.llm.store import Store


def expected_fingerprint(text: str | None, n: int) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closest(rows: list[tuple], distance: int) -> list:
    """The smallest key of each row's component, by comparing all pairs."""
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if ((a ^ rows[j][1]) & (2**64 - 1)).bit_count() <= distance:
                top[find(i)] = find(j)
    least: dict[int, list] = {}
    for i, (key, _) in enumerate(rows):
        least.setdefault(find(i), []).append(key)
    named = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [named[find(i)] for i in range(len(rows))]


@pytest.mark.parametrize(("distance", "max_cell"), [(2, 256), (2, 3), (3, 3), (0, 256), (1, 2)])
def test_links_equal_all_pairs(spark, distance, max_cell):
    r = random.Random(distance)
    prints = {r.getrandbits(64) for _ in range(30)} | {0, 1, 2**64 - 1}
    for start in sorted(prints):
        for _ in range(6):
            for _ in range(r.randint(1, 4)):
                start ^= 1 << r.randrange(64)
            prints.add(start)
    signed = sorted(x - 2**64 if x >> 63 else x for x in prints)
    store = Store(spark)
    frame = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    tied = components(simhash.links(frame, distance, store, max_cell), store, "t").collect()
    root = {row.a: row.b for row in tied}
    assert [root.get(x, x) for x in signed] == closest([(x, x) for x in signed], distance)


def test_a_long_chain_is_one_component(spark):
    links = spark.range(1, 400).selectExpr("id AS a", "id - 1 AS b")
    made = components(links, Store(spark), "chain")
    assert made.where("b <> 0").isEmpty()
    assert made.count() == 399


def test_hard_documents(hard_docs):
    rows = simhash.near_duplicates(hard_docs, 3, 2).collect()
    texts = [(r.doc_id, expected_fingerprint(r.text, 3)) for r in hard_docs.collect()]
    want = sorted(
        (str(k), f - 2**64 if f >> 63 else f, str(c))
        for (k, f), c in zip(texts, closest(texts, 2), strict=True)
    )
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want


def test_one_document_of_each_component_stays(hard_docs):
    kept = simhash.keep_one(hard_docs, 3, 2)
    assert kept.columns == hard_docs.columns
    prints = [(i, expected_fingerprint(r.text, 3)) for i, r in enumerate(kept.collect())]
    assert closest(prints, 2) == list(range(len(prints)))  # no two are linked
    assert kept.where("text = ''").count() <= 1


def test_no_documents(no_docs):
    assert simhash.near_duplicates(no_docs, 3, 2).count() == 0
    assert simhash.keep_one(no_docs, 3, 2).columns == no_docs.columns


@pytest.mark.parametrize("sf_dir", [SMALL, MIDDLE])
def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    texts = [(r.doc_id, expected_fingerprint(r.text, 3)) for r in docs]
    want = {k: (f"{f:016x}", c) for (k, f), c in zip(texts, closest(texts, 2), strict=True)}
    rows = queries.op5_simhash_near_dedup(spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want
