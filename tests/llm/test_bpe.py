from __future__ import annotations

import random

import public_tokenizers
import pytest
from hard_texts import SMALL
from tokenizers import Tokenizer

from linkloom.llm import bpe, queries

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(VOCABULARY)
    made.no_truncation()
    made.no_padding()
    return made


@pytest.fixture(scope="module")
def encoder():
    with open(VOCABULARY, "rb") as file:
        return bpe.WordBpe(file.read())


def both(library, encoder, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert encoder.encode(text).tolist() == ids, text
    assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False), text


@pytest.mark.parametrize("text", [
    "", "  ", "ΑΣ ΟΔΟΣ", "İstanbul ﬁ ǅ", "a\x1cb\x1d c\x85d\xa0e", "ẛ̣ é", "日本 🎉🏳️‍🌈", "½ ² ٣ 12",
    "x<|endoftext|>Y <|STARTOFTEXT|> <|startoftext|>'S it's they'll", "<|endoftext|><|endoftext|>",
    "hahahahahaha" * 20, "a" * 3000, "​ x　y﻿",
])
def test_equals_the_library(library, encoder, text):
    both(library, encoder, text)


@pytest.mark.parametrize("letters", ["abehnrst'’ \n\t012éñßΣσİ🎉中́\x1c!#<|>", "aehinrst", "ab"])
def test_equals_the_library_on_random_texts(library, encoder, letters):
    r = random.Random(letters)
    for _ in range(4000):
        both(library, encoder, "".join(r.choice(letters) for _ in range(r.randint(1, 40))))


def test_small_caches_change_nothing(library):
    with open(VOCABULARY, "rb") as file:
        encoder = bpe.WordBpe(file.read(), cached=3)
    both(library, encoder, "many different words pass through caches that hold only a few words")


def test_hard_documents(hard_docs, library):
    coded = bpe.decode(bpe.encode(hard_docs, VOCABULARY), VOCABULARY)
    assert sorted(coded.columns) == sorted(hard_docs.columns)  # replaced, not doubled
    for row in coded.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == ids
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_no_documents(no_docs):
    assert bpe.encode(no_docs, VOCABULARY).count() == 0


def test_query(spark, library):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op8_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_one_pass_without_shuffle(spark):
    plan = queries.op8_bpe(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
