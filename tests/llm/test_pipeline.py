from __future__ import annotations

import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
from hard_texts import SMALL
from test_line_dedup import expected as without_repeated_runs
from test_simhash import closest, expected_fingerprint
from tokenizers import Tokenizer

from linkloom.llm import queries
from linkloom.llm.store import Store


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage returns, beginning with its input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    store, out = Store(spark), [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(store.put(name, stage(spark, out[-1], SMALL)))
    return out


def test_stages_keep_the_columns(stages):
    assert all(x.columns == stages[0].columns for x in stages[1:-1])


def test_rules_keep_what_the_query_keeps(spark, stages):
    kept = {r.doc_id for r in queries.op9_quality_rules(spark, SMALL).where("kept").collect()}
    assert {r.doc_id for r in stages[1].collect()} == kept


def test_lines(stages):
    before = sorted(stages[1].collect(), key=lambda r: r.doc_id)
    want = without_repeated_runs([r.text for r in before], 2, 50)
    want = {
        r.doc_id: t for r, t in zip(before, want, strict=True) if t == r.text or (t or "").strip()
    }
    assert {r.doc_id: r.text for r in stages[2].collect()} == want


def test_one_of_each_group_of_near_duplicates_stays(stages):
    rows = [(r.doc_id, expected_fingerprint(r.text, 3)) for r in stages[2].collect()]
    assert {r.doc_id for r in stages[3].collect()} == set(closest(rows, 2))


def test_leaks_go(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaked = {r.doc_id for r in stages[3].collect() if any(t in (r.text or "") for t in items)}
    assert {r.doc_id for r in stages[4].collect()} == {r.doc_id for r in stages[3].collect()} - leaked


def test_tokens(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    texts = {r.doc_id: r.text or "" for r in stages[4].collect()}
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == texts.keys()
    for row in rows:
        assert row.ids == library.encode(texts[row.doc_id], add_special_tokens=False).ids
        text = library.decode(row.ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_run_is_all_stages(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SMALL).collect()) == sorted(stages[5].collect())


def test_hard_documents(spark, hard_docs, no_docs):
    for docs in (hard_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = Store(spark).put("stage", stage(spark, docs, SMALL))
            assert docs.columns == hard_docs.columns
        corpus_pipeline.tokens(spark, docs, SMALL).collect()
