from __future__ import annotations

import random

import pytest
from compare import assert_same, duck
from hard_texts import MIDDLE, SMALL

from linkloom.llm import line_dedup, queries
from linkloom.llm.store import Store


def expected(texts: list[str | None], m: int, min_words: int | None = None) -> list[str | None]:
    """Delete by looking up every run of m lines, and every line of ``min_words``, in the order given."""
    seen, out = set(), []
    gone_of = []
    for text in texts:
        lines = [] if text is None else text.split("\n")
        places = [i for i, x in enumerate(lines) if x.encode().strip()]
        gone = set()
        for i in range(len(places) - m + 1):
            run = tuple(lines[p] for p in places[i : i + m])
            if run in seen:
                gone |= set(places[i : i + m])
            seen.add(run)
        for p in places if min_words else []:
            if len(lines[p].encode().split()) >= min_words:
                if lines[p] in seen:
                    gone.add(p)
                seen.add(lines[p])
        gone_of.append(gone)
        out.append(None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_runs_and_long_lines_together(spark):
    r = random.Random(9)
    words = [" ".join(r.choice("xyz") for _ in range(r.choice([1, 2, 6, 7]))) for _ in range(30)]
    texts = ["\n".join(r.choice(words) for _ in range(r.randint(0, 12))) for _ in range(80)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    rows = sorted(line_dedup.delete_repeated_runs(frame, 2, min_words=6).collect())
    assert [row.text for row in rows] == expected(texts, 2, 6)


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_equals_looking_up_every_run(spark, m):
    r = random.Random(m)
    texts = ["\n".join(r.choice("abcdefg ") * 2 for _ in range(r.randint(0, 25))) for _ in range(60)]
    texts += ["\n".join(["same"] * 30), "\n".join(["same"] * 9), None, "", texts[0], "\n".join("pqrstuv")]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    rows = sorted(line_dedup.delete_repeated_runs(frame, m).collect())
    assert [row.text for row in rows] == expected(texts, m)


def test_a_long_line_alone_is_a_run(spark):
    """Copies of one line of 50 words go, within several lines and as whole documents."""
    long, short = [" ".join(f"{x}{i}" for i in range(n)) for x, n in (("a", 50), ("b", 49))]
    texts = [f"p\n{long}\nq", f"r\n{long}\n{short}", long, short, f"{long}\ns\n{long}", f"p\n{long}", None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    rows = sorted(line_dedup.delete_repeated_runs(frame, 2, min_words=50).collect())
    assert [r.text for r in rows] == [texts[0], f"r\n{short}", "", short, "s", "", None, ""]
    assert [r.lines_deleted for r in rows] == [0, 1, 1, 0, 2, 2, 0, 0]
    kept = line_dedup.keep_new_lines(frame, 2, min_words=50)
    assert {r.doc_id for r in kept.collect()} == {0, 1, 3, 4, 6, 7}


def test_the_suffix_array_is_sorted_and_its_prefixes_are_right(spark):
    r = random.Random(5)
    texts = ["\n".join(r.choice("ab") for _ in range(r.randint(1, 20))) for _ in range(12)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    store = Store(spark)
    sequences = line_dedup._sequences(frame, "id", "text", store)
    lines, suffixes = line_dedup.suffix_array(sequences, store)
    common = line_dedup.with_common_prefix(lines, suffixes, store)
    of = {}
    for row in sorted(lines.collect(), key=lambda x: (x.doc, x.i)):
        of.setdefault(row.doc, []).append(row.line)
    order = sorted(common.collect(), key=lambda x: x.rank)
    before = None
    for row in order:
        # The end of a document sorts before all lines.
        suffix = [(1, x) for x in of[row.doc][row.i :]] + [(0, row.doc)]
        if before is not None:
            assert before < suffix
            same = next(i for i, (x, y) in enumerate(zip(before, suffix, strict=False)) if x != y)
            assert row.lcp == same
        before = suffix
    assert len(order) == sum(map(len, of.values()))


def test_hard_documents(hard_docs):
    made = line_dedup.delete_repeated_runs(hard_docs, 2)
    assert sorted(made.columns) == sorted(hard_docs.columns)
    rows = {(r.doc_id, r.n_chars): r for r in made.collect()}
    assert made.count() == hard_docs.count()
    assert rows[(None, 9)].text == "two words"
    assert [r.text for r in made.where("doc_id = 6").collect()] == ["the same line\nand the next\nand one more"] * 2
    assert made.where("doc_id = 7").first().text == "start\nend"
    assert made.where("doc_id = 8").first().text == ""
    assert made.where("doc_id = 0").first().text is None


def test_kept_documents(hard_docs):
    kept = line_dedup.keep_new_lines(hard_docs)
    assert kept.columns == hard_docs.columns
    assert kept.where("doc_id = 8").isEmpty()  # nothing of it is left
    assert kept.where("doc_id = 7").first().n_chars == len("start\nend")
    assert kept.where("doc_id IN (1, 2, 3)").count() == 3  # blank, but not by deletion


def test_no_documents(no_docs):
    assert line_dedup.delete_repeated_runs(no_docs).count() == 0


@pytest.mark.parametrize("sf_dir", [SMALL, MIDDLE])
def test_query_equals_sql(spark, sf_dir):
    sql = queries.ORACLE_SQL["op2_line_dedup"]
    assert assert_same(queries.op2_line_dedup(spark, sf_dir), duck(sf_dir), sql) > 0
