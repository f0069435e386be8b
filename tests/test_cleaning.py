import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from linkloom.operators import cleaning
from linkloom.operators.quality import stage_counts
from linkloom.sources.delimited import ORDINAL

PATENT = "patent_id string, title string, abstract string, date string"


def raw(spark, schema, rows):
    """Rows in the order given."""
    numbered = [(*row, i) for i, row in enumerate(rows)]
    return spark.createDataFrame(numbered, f"{schema}, {ORDINAL} int").repartition(4)


def as_set(frame):
    return {tuple(r) for r in frame.collect()}


def patents(spark, rows):
    return raw(spark, PATENT, rows)


def test_first_valid_row_wins(spark):
    rows = [
        ("p", "bad date", "", "2020-99-01"), ("p", "second", " x ", "2020-01-02"),
        ("p", "third", "", "2020-01-03"), ("q", "only", None, "2020-1-4"),
    ]
    assert as_set(cleaning.clean_patents(patents(spark, rows))) == {
        ("p", "second", "x", date(2020, 1, 2), 2020), ("q", "only", None, date(2020, 1, 4), 2020),
    }


def test_year_range_titles_and_keys(spark):
    rows = [
        ("a", "t", "", "1975-12-31"), ("b", "t", "", "1976-01-01"), ("c", "t", "", "2030-12-31"),
        ("d", "t", "", "2031-01-01"), ("e", None, "", "2000-01-01"), ("f", " \u3000", "", "2000-01-01"),
        (None, "t", "", "2000-01-01"), ("g", "t", "", None),
    ]
    kept = cleaning.clean_patents(patents(spark, rows))
    assert {r.patent_id for r in kept.collect()} == {"b", "c"}
    report = stage_counts(cleaning.patents_stage(patents(spark, rows)), "patents").collect()
    assert [tuple(r) for r in report] == [("patents", 8, 2)]


def test_schema(spark):
    assert cleaning.clean_patents(patents(spark, [])).dtypes == [
        ("patent_id", "string"), ("title", "string"), ("abstract", "string"),
        ("filing_date", "date"), ("year", "int"),
    ]


def test_inventor_names_ids_and_countries(spark):
    schema = """inventor_id string, disambig_inventor_id string, name_first string,
        name_last string, country string"""
    rows = [
        ("r1", None, " Ann ", "Lee\t", "usa"), ("r2", "d2", None, "Solo", None),
        ("r3", "d2", "Late", "Copy", "de"), ("r4", "d4", " ", "\u00a0", "fr"),
        (None, None, "No", "Id", "fr"), (None, None, "No", "Id two", "gb"),
        ("r5", "d5", "First", None, "  "),
    ]
    assert as_set(cleaning.clean_inventors(raw(spark, schema, rows))) == {
        ("r1", "Ann Lee", "US"), ("d2", "Solo", "UNKNOWN"), (None, "No Id", "FR"),
        ("d5", "First", "UNKNOWN"),
    }
    literal = cleaning.clean_inventors(raw(spark, schema, rows), literal_nulls=True)
    assert ("d2", "Solo", "UN") in as_set(literal)


def test_columns_that_files_may_lack(spark):
    rows = [("i1", "Lee", "US")]
    frame = raw(spark, "inventor_id string, name_last string, country string", rows)
    assert as_set(cleaning.clean_inventors(frame)) == {("i1", "Lee", "US")}
    frame = raw(spark, "assignee_id string, organization string, country string",
                [("a", " Acme  Inc ", "us"), ("b", None, "us"), ("a", "Other", "us")])
    assert as_set(cleaning.clean_companies(frame)) == {("a", "Acme  Inc", "US")}
    with_disambig = frame.withColumn("disambig_assignee_id", F.lit("z"))
    assert as_set(cleaning.clean_companies(with_disambig)) == {("z", "Acme  Inc", "US")}


def test_links(spark):
    schema = "patent_id string, inventor_id string, disambig_inventor_id string, sequence string"
    rows = [
        ("p", "i", None, "0"), ("p", "x", "i", "1"), ("p", None, "j", "2"), ("zz", "i", None, "0"),
        ("p", "zz", None, "3"), (None, "i", None, "0"), ("p", None, None, "0"), ("q", "i", "i", "0"),
    ]
    links = spark.createDataFrame(rows, schema)
    patent_ids = spark.createDataFrame([("p",), ("q",), ("q",), (None,)], "patent_id string")
    inventor_ids = spark.createDataFrame([("i",), ("j",), ("i",), (None,)], "inventor_id string")
    clean = cleaning.clean_patent_inventors(links, patent_ids, inventor_ids)
    assert sorted(tuple(r) for r in clean.collect()) == [("p", "i"), ("p", "j"), ("q", "i")]
    company = links.select("patent_id", F.col("inventor_id").alias("assignee_id"))
    firms = inventor_ids.withColumnRenamed("inventor_id", "company_id")
    clean = cleaning.clean_patent_companies(company, patent_ids, firms)
    assert sorted(tuple(r) for r in clean.collect()) == [("p", "i"), ("q", "i")]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_loop(spark, seed):
    """A third of all rows share one id; partitions and order in memory do not matter."""
    rng = random.Random(seed)
    titles, dates = ["a", " b ", "", None, "c\td"], ["2020-1-1", "1999-05-06", "x", None, "1970-01-01"]
    rows = [
        ("hot" if rng.random() < 0.33 else f"p{rng.randrange(300)}", rng.choice(titles),
         rng.choice(["", "z", None]), rng.choice(dates))
        for _ in range(3000)
    ]
    expected = {}
    for pid, title, abstract, day in rows:
        name = " ".join((title or "").split())
        if name and day in ("2020-1-1", "1999-05-06") and pid not in expected:
            y, m, d = map(int, day.split("-"))
            expected[pid] = (pid, name, abstract or None, date(y, m, d), y)
    for parts in (1, 7):
        frame = patents(spark, rows).repartition(parts)
        assert as_set(cleaning.clean_patents(frame)) == set(expected.values())


def test_cleaning_twice_changes_nothing(spark):
    rows = [("p", " A  b", " c ", "2020-1-2"), ("q", "D", "", "2021-03-04")]
    once = cleaning.clean_patents(patents(spark, rows))
    again = once.select(
        "patent_id", "title", "abstract", F.date_format("filing_date", "yyyy-MM-dd").alias("date"),
        F.lit(0).alias(ORDINAL),
    )
    assert as_set(cleaning.clean_patents(again)) == as_set(once)
