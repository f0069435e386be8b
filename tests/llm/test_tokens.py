from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hard_texts import SMALL, TEXTS

from linkloom.llm import byte_tokens, queries, token_counts
from linkloom.llm import training_order as order
from linkloom.llm.store import Store

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoder():
    with open(RANKS, "rb") as file:
        return byte_tokens.ByteTokens(file.read(), PATTERN)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
@pytest.mark.parametrize("key", [0, 5, -1])
def test_the_permutation_is_one(n, key):
    slots = order.permute(np.arange(n), n, key)
    assert sorted(slots) == list(range(n))
    assert (order.unpermute(slots, n, key) == np.arange(n)).all()


def feistel(x: int, n: int, key: int) -> int:
    """The slot of a number, with plain numbers."""
    bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)

    def mix(x: int, k: int) -> int:
        x = ((x ^ k) * 0x9E3779B97F4A7C15) % 2**64
        x = ((x ^ x >> 32) * 0xD6E8FEB86659FD93) % 2**64
        return x ^ x >> 32

    keys = [mix(i, key % 2**64) for i in range(1, 7)]
    while True:
        left, right = x >> bits, x % 2**bits
        for k in keys:
            left, right = right, left ^ mix(right, k) % 2**bits
        x = left << bits | right
        if x < n:
            return x


def streams(encoder, ids: bytes) -> Counter:
    """The texts' tokens in a stream of sequences, without empty ones."""
    tokens = np.frombuffer(ids, np.uint16)
    parts = np.split(tokens, np.flatnonzero(tokens == encoder.end) + 1)
    return Counter(p[:-1].tobytes() for p in parts if len(p) > 1)


def test_shards_hold_every_text_in_the_order_of_the_key(spark, hard_docs, encoder):
    docs = Store(spark).put("docs", hard_docs.select("text", "doc_id").repartition(3))
    want = Counter(encoder.encode(r.text or "") for r in docs.collect() if r.text)
    slots = {}
    for key in (1, 2):
        path = Store(spark).path("training")
        order.materialise(docs, path, RANKS, PATTERN, key, length=64, shard=100)
        rows = sorted(order.read(spark, path).collect(), key=lambda r: r.sequence)
        assert len({r.sequence for r in rows}) == len({r.slot for r in rows}) == len(rows)
        n = len(rows)
        assert [r.slot for r in sorted(rows)] == list(range(n))
        for r in rows:
            assert r.shard == r.slot // 100 and r.offset == r.slot % 100 * 137
            assert r.slot == feistel(r.sequence, n, key)
        assert streams(encoder, b"".join(r.ids for r in rows)) == want
        slots[key] = [r.slot for r in rows]
        later = order.read(spark, path, first_slot=150).collect()
        assert sorted(r.slot for r in later) == sorted(r.slot for r in rows if r.slot >= 150)
    assert slots[1] != slots[2]


def test_records_lie_where_readers_look(spark, encoder):
    """Plain reads of the files, without Spark."""
    from pathlib import Path

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    path = Store(spark).path("training")
    order.materialise(docs, path, RANKS, PATTERN, 3, length=32, shard=500)
    files = sorted(Path(path.removeprefix("file://")).glob("shards/part-*"))
    for row in order.read(spark, path).where("slot % 17 = 0").collect():
        with open(files[row.shard], "rb") as file:
            file.seek(row.offset)
            assert int.from_bytes(file.read(8), "little") == row.slot
            assert file.read(64) == bytes(row.ids)
            assert file.read(1) == b"\n"


def test_no_documents(spark, no_docs):
    docs = Store(spark).put("docs", no_docs.select("text"))
    path = Store(spark).path("training")
    order.materialise(docs, path, RANKS, PATTERN, 1)
    assert order.read(spark, path).count() == 0
    assert token_counts.histogram(token_counts.lengths(no_docs, RANKS, PATTERN, [])).count() == 0


def check_histogram(rows, lengths):
    n = np.array(lengths)
    assert sorted(r.n_tokens for r in rows) == sorted(set(lengths))
    for r in rows:
        k = r.n_tokens
        assert r.docs == (n == k).sum() and r.docs_at_least == (n >= k).sum()
        assert r.tokens_at_least == n[n >= k].sum() and r.docs_total == len(n)
        assert r.tokens_total == n.sum() and r.truncated_total == np.minimum(n, k).sum()
        assert r.quantile == pytest.approx((n <= k).mean())


def test_counts_of_hard_documents(spark, hard_docs, encoder):
    made = token_counts.lengths(hard_docs, RANKS, PATTERN, ["doc_id", "n_words"])
    lengths = [len(encoder.encode(r.text or "")) // 2 for r in hard_docs.collect()]
    assert sorted(r.n_tokens for r in made.collect()) == sorted(lengths)
    hist = token_counts.histogram(made)
    check_histogram(hist.collect(), lengths)
    limits = spark.createDataFrame([(0,), (3,), (3,), (1000,), (10**7,)], "max_tokens long")
    n = np.array(lengths)
    for r in token_counts.at_limits(hist, limits).collect():
        assert r.docs_longer == (n > r.max_tokens).sum()
        assert r.truncated_total == np.minimum(n, r.max_tokens).sum()
    assert token_counts.at_quantile(hist, 0.5).first().n_tokens == np.sort(n)[(len(n) - 1) // 2]
    assert token_counts.at_limits(hist.limit(0), limits).where("truncated_total <> 0").isEmpty()


def test_query_counts(spark, encoder):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    check_histogram(
        queries.op10_token_counts(spark, SMALL).collect(),
        [len(encoder.encode(r.text or "")) // 2 for r in docs],
    )


def test_query_order(spark, encoder):
    """Every sequence of the input, at the slot that an independent network gives its number."""
    rows = queries.op1_training_order(spark, SMALL).collect()
    n = len(rows)
    assert sorted(r.slot for r in rows) == sorted(r.sequence for r in rows) == list(range(n))
    for r in rows:
        assert r.slot == feistel(r.sequence, n, 20240517)
        assert (r.shard, r.offset) == (r.slot // 8192, r.slot % 8192 * 2057)
    texts = [r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    end = np.uint16(encoder.end).tobytes()
    stream = b"".join(encoder.encode(t) + end for t in texts)
    stream += end * (-len(stream) // 2 % 1024)
    want = [hashlib.sha256(stream[i : i + 2048]).hexdigest() for i in range(0, len(stream), 2048)]
    assert [r.ids_sha256 for r in sorted(rows, key=lambda r: r.sequence)] == want


@pytest.mark.parametrize("blank", [" ", "\n", "\t", "\u3000", "\x1c", " \n"])
@pytest.mark.parametrize("after", ["", "word", "!", "\x1c"])
def test_long_runs_are_encoded_as_short_ones(encoder, blank, after):
    plain = encoder.encoding.encode_ordinary
    for n in (4_999, 5_000, 5_001, 60_000):
        text = f"a {blank * n}{after} end" if after else f"a{blank * n}"
        assert encoder.ids(text) == plain(text)


@pytest.mark.parametrize("blank", [" ", "\n", "\t"])
def test_blanks_beyond_the_stack(encoder, blank):
    text = f"one{blank * 5_000_000}two"
    ids = encoder.ids(text)
    assert encoder.encoding.decode(ids) == text and encoder.count(text) == len(ids)
