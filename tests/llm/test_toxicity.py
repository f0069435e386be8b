from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hard_texts import MIDDLE
from pyspark.sql import functions as F

from linkloom.llm import queries, toxicity
from linkloom.llm.store import Store

CLEAN = "the quiet river runs under old trees while people walk home along its banks".split()
LARGE = "/root/testdata/sf0.1"
INSULTS = ["idiot", "moron", "lowlife"]


def brute_segments(scores):
    """Ruzzo and Tompa's definition, by recursion: the best part, then what is left of either side."""
    if not any(s > 0 for s in scores):
        return []
    total = np.concatenate(([0], np.cumsum(scores)))
    a, b = max(
        ((i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
        key=lambda x: (total[x[1]] - total[x[0]], x[0] - x[1]),
    )
    left = brute_segments(scores[:a])
    right = [(s, f + b, e + b) for s, f, e in brute_segments(scores[b:])]
    return [*left, (int(total[b] - total[a]), a, b), *right]


def test_segments_equal_the_definition():
    draw = random.Random(3)
    for _ in range(400):
        scores = [draw.choice([-3, -2, -1, -1, 0, 1, 2, 4]) for _ in range(draw.randrange(18))]
        got = toxicity.segments(np.array(scores, np.int64))
        assert [s for s, _, _ in got] == [s for s, _, _ in brute_segments(scores)], scores
        for (s, a, b), (_, a2, b2) in zip(got, got[1:], strict=False):
            assert b <= a2 and s == sum(scores[a:b])


def test_segments_of_long_texts_take_linear_time():
    scores = np.tile(np.array([2, -1, -2, 3, -1], np.int64), 400_000)
    got = toxicity.segments(scores)
    assert sum(s for s, _, _ in got) >= scores.sum()


def corpus(n=1500, seed=1):
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [draw.choice(CLEAN) + draw.choice(["", "s", "ly"]) for _ in range(draw.randrange(5, 80))]
        toxic = draw.random() < 0.2
        if toxic:
            for _ in range(draw.randrange(1, 4)):
                words.insert(draw.randrange(len(words)), draw.choice(INSULTS) + draw.choice(["", "s", "x" * draw.randrange(5)]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    return toxicity.fit(frame, known, Store(spark), F.col("doc_id") % 2 == 0), frame, dict(labels)


def test_finds_toxic_texts_it_was_not_taught(fitted):
    model, frame, labels = fitted
    rows = [r for r in toxicity.judge(frame, model, ["doc_id"]).collect() if r["doc_id"] % 2]
    right = sum((r["score"] >= 0.3) == bool(labels[r["doc_id"]]) for r in rows)
    assert right / len(rows) > 0.98
    assert any(u.endswith("*") for u in model.lexicon) and model.rate > 0


def test_passages_are_places_in_the_text(spark, fitted):
    model = fitted[0]
    text = f"{' '.join(CLEAN * 20)} Ünd you IDIOT, you moron! {' '.join(CLEAN * 20)}"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = toxicity.judge(frame, model, ["doc_id"]).collect()
    (passage,) = row["passages"]
    assert text[passage["first"] : passage["end"]] == "IDIOT, you moron"
    assert passage["expected"] < toxicity.ALPHA and row["score"] > 0.5


def test_a_long_clean_text_needs_more_evidence(fitted):
    model = fitted[0]
    assert model.normal(30, 100_000) < model.normal(30, 100)


def test_pieces_change_nothing(fitted, monkeypatch):
    model, text = fitted[0], " ".join(CLEAN * 40 + INSULTS + CLEAN * 40)
    whole = model.found(text, toxicity._Memo(model.lexicon))
    monkeypatch.setattr(toxicity, "_PIECE", 13)
    assert model.found(text, toxicity._Memo(model.lexicon)) == whole
    spans = [(a, b) for _, a, b in whole[1]]
    places = toxicity._places(text, spans)
    monkeypatch.setattr(toxicity, "_PIECE", 1 << 20)
    assert toxicity._places(text, spans) == places


def test_hard_texts(spark, fitted, hard_docs):
    made = toxicity.judge(hard_docs, fitted[0], ["doc_id", "_key", "a.b", "lang"])
    rows = made.collect()
    assert len(rows) == hard_docs.count() and made.columns[:4] == ["doc_id", "_key", "a.b", "lang"]
    assert all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (0, 1, 2, 3)}
    assert len(empty) == 1 and all(r["n_tokens"] == 0 for r in rows if r["doc_id"] in (0, 1, 2, 3))


def test_without_usable_labels(spark, hard_docs, no_docs):
    kind = "doc_id long, toxic int"
    for rows, score in [([], 0.0), ([(4, 0), (5, 0)], 0.25), ([(4, None), (5, 0), (5, 1)], 0.0)]:
        model = toxicity.fit(hard_docs, spark.createDataFrame(rows, kind), Store(spark))
        got = {round(r["score"], 9) for r in toxicity.judge(hard_docs, model, ["doc_id"]).collect()}
        assert got == {score}, rows
        assert toxicity.judge(no_docs, model, ["doc_id"]).collect() == []
    assert toxicity.fit(no_docs, spark.createDataFrame([(1, 1), (2, 0)], kind), Store(spark)).lexicon == {}


def test_one_id_with_a_third_of_all_rows_is_taught_once(spark):
    docs, labels = corpus(400)
    many = docs + [(9, "idiot " + t) for _, t in docs[:200]]
    sample = toxicity.labelled(
        spark.createDataFrame(many, "doc_id long, text string"),
        spark.createDataFrame(labels + [(3, 1 - labels[3][1])], "doc_id long, toxic int"),
        "text", F.lit(True), 1000,
    )
    ids = [r["doc_id"] for r in sample.collect()]
    assert sorted(ids) == [i for i in range(400) if i != 3]


def test_stems_need_several_words_and_copies_count_once(spark):
    """Of 40 copies of a toxic text nothing is learnt but what other texts show too."""
    docs, labels = corpus(400)
    docs += [(1000 + i, "unusual words stand in this one text") for i in range(40)]
    labels += [(1000 + i, 1) for i in range(40)]
    model = toxicity.fit(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"), Store(spark),
    )
    assert "idiot" in model.lexicon and "moron" in model.lexicon
    assert not {u for u in model.lexicon if u.startswith(("unu", "text", "stand"))}
    assert model.lexicon.get("idi*", 0) < model.lexicon["idiot"]


def test_query(spark):
    rows = queries.op13_toxicity(spark, LARGE).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{LARGE}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in held) / len(held) >= 0.97
    assert sum(p for p, y in held if y) / sum(y for _, y in held) >= 0.9


def test_held_out_labels_are_never_read(spark, tmp_path):
    """Other labels of held-out documents leave every score as it is."""
    for name in ("documents", "labels"):
        table = spark.read.parquet(f"{MIDDLE}/{name}.parquet")
        if name == "labels":
            held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
            table = table.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    got, want = (
        {r["doc_id"]: r["score"] for r in queries.op13_toxicity(spark, d).collect()}
        for d in (str(tmp_path), MIDDLE)
    )
    assert got == want
