"""Raw files to reports, end to end."""

import csv
import json
from datetime import date
from pathlib import Path

import pytest

from linkloom.plans.job import run_job
from linkloom.plans.reports import SUMMARY_SCHEMA, read_summary, write_page_exports
from linkloom.sources.delimited import read_clean_csv
from linkloom.sources.parquet import read_tables, write_tables

RAW = {
    "g_patent": """patent_id\ttype\tdate\tabstract\ttitle
P1\tutility\t2019-03-04\t"two\nlines"\t  A   title
P2\tutility\t2020-1-5\t\t"say ""x"", y"
P2\tutility\t2020-01-06\tlate\tcopy
P3\tutility\t2020/01/06\t\tbad date
P4\tutility\t1970-01-01\t\ttoo early
P5\tutility\t2020-07-08\tNA\tNA
P6\tutility\t2020-07-08\tNA\tlast
""",
    "g_inventor_disambiguated": """inventor_id\tname_first\tname_last\tcountry
i1\tAnn\tLee\tus
i2\tBo\t\tNA
i3\t\t\tde
i4\tCy\tOh\t
""",
    "g_assignee_disambiguated": """assignee_id\torganization\tcountry\tassignee_type
a1\tAcme, Inc\tusa\t2
a2\t\tde\t2
""",
    "g_patent_inventor": """patent_id\tinventor_id\tdisambig_inventor_id\tsequence
P1\ti1\ti1\t0
P1\ti1\ti1\t1
P1\tx\ti2\t2
P2\ti1\t\t0
P2\ti3\t\t1
P3\ti1\t\t0
P6\ti4\ti4\t0
P6\t\t\t1
""",
    "g_patent_assignee": """patent_id\tassignee_id\tdisambig_assignee_id\tsequence
P1\ta1\ta1\t0
P2\ta1\ta1\t0
P6\ta2\ta2\t0
""",
}


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    (base / "raw").mkdir()
    for name, body in RAW.items():
        (base / "raw" / f"{name}.tsv").write_bytes(body.encode())
    report = run_job(spark, f"{base}/raw", f"{base}/out", charts=True)
    return base, report


def lines(folder: Path):
    (part,) = folder.glob("part-*.csv")
    return list(csv.reader(part.open(newline="")))


def test_drop_report(done):
    assert [tuple(r) for r in done[1].collect()] == [
        ("patents", 7, 3, 4, 57.1), ("inventors", 4, 3, 1, 25.0), ("companies", 2, 1, 1, 50.0),
        ("patent_inventors", 8, 4, 4, 50.0), ("patent_companies", 3, 2, 1, 33.3),
    ]


def test_tables(spark, done):
    t = read_tables(spark, f"{done[0]}/out/tables")
    assert sorted(tuple(r) for r in t.patents.collect()) == [
        ("P1", "A title", "two lines", date(2019, 3, 4), 2019),
        ("P2", 'say "x", y', None, date(2020, 1, 5), 2020),
        ("P6", "last", None, date(2020, 7, 8), 2020),
    ]
    assert sorted(tuple(r) for r in t.inventors.collect()) == [
        ("i1", "Ann Lee", "US"), ("i2", "Bo", "NA"), ("i4", "Cy Oh", "UNKNOWN"),
    ]
    assert sorted(tuple(r) for r in t.patent_inventors.collect()) == [
        ("P1", "i1"), ("P1", "i2"), ("P2", "i1"), ("P6", "i4"),
    ]
    folders = (done[0] / "out/tables").glob("versions/*/patents/year=*")
    assert {p.name for p in folders} == {"year=2019", "year=2020"}


def test_clean_csv_reads_back_the_same(spark, done):
    stored = read_tables(spark, f"{done[0]}/out/tables")
    loaded = read_clean_csv(spark, f"{done[0]}/out/clean")
    for (name, a), (_, b) in zip(stored.items(), loaded.items()):
        assert a.dtypes == b.dtypes
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0, name
    text = "".join(p.read_text() for p in (done[0] / "out/clean/clean_patents.csv").glob("part-*"))
    assert "P6,last,,2020-07-08,2020" in text


def test_report_files(done):
    reports = done[0] / "out/reports"
    assert lines(reports / "top_inventors.csv") == [
        ["name", "country", "patents"], ["Ann Lee", "US", "2"], ["Bo", "NA", "1"],
        ["Cy Oh", "UNKNOWN", "1"],
    ]
    assert lines(reports / "top_companies.csv") == [
        ["company", "country", "patents"], ["Acme, Inc", "US", "2"],
    ]
    assert lines(reports / "country_trends.csv") == [
        ["country", "patents", "share_pct"], ["US", "2", "50.0"], ["NA", "1", "25.0"],
    ]
    assert lines(reports / "yearly_trends.csv") == [
        ["year", "patents"], ["2019", "1"], ["2020", "2"],
    ]
    assert lines(reports / "ranked_inventors.csv")[1:3] == [
        ["1", "Ann Lee", "US", "2", "50.0"], ["2", "Bo", "NA", "1", "25.0"],
    ]
    assert lines(reports / "charts/chart_country_trend.csv") == [
        ["year", "NA", "US"], ["2019", "1", "1"], ["2020", "0", "1"],
    ]
    assert len(list((reports / "charts").glob("chart_*.csv"))) == 5


def test_summary(spark, done):
    (part,) = (done[0] / "out/reports/summary_report.json").glob("part-*.json")
    summary = json.loads(part.read_text())
    assert summary["total_patents"] == 3
    assert summary["yearly_trends"] == [{"year": 2019, "patents": 1}, {"year": 2020, "patents": 2}]
    back = read_summary(spark, f"{done[0]}/out/reports")
    assert back.schema == spark.createDataFrame([], SUMMARY_SCHEMA).schema
    assert back.collect()[0].top_countries[0].share_pct == 50.0


def test_page_exports(spark, done, tmp_path):
    t = read_tables(spark, f"{done[0]}/out/tables", unique_links=True)
    write_page_exports(t, str(tmp_path), 2020, 2020)
    assert lines(tmp_path / "top_inventors.csv") == [
        ["Rank", "name", "country", "patents"], ["1", "Ann Lee", "US", "1"],
        ["2", "Cy Oh", "UNKNOWN", "1"],
    ]
    assert lines(tmp_path / "country_trends.csv")[1] == ["1", "US", "1", "25.0"]


def test_second_run_replaces_the_first(spark, done):
    base, first = done
    before = {n: sorted(f.collect()) for n, f in read_tables(spark, f"{base}/out/tables").items()}
    again = run_job(spark, f"{base}/raw", f"{base}/out", literal_nulls=False)
    assert again.collect() == first.collect()
    after = {n: sorted(f.collect()) for n, f in read_tables(spark, f"{base}/out/tables").items()}
    assert after == before


def test_literal_nulls(spark, done):
    run_job(spark, f"{done[0]}/raw", f"{done[0]}/literal", csv=False, literal_nulls=True)
    t = read_tables(spark, f"{done[0]}/literal/tables")
    assert {r.inventor_id: r.country for r in t.inventors.collect()} == {
        "i1": "US", "i2": "UN", "i4": "UN",
    }
    assert not (done[0] / "literal/clean").exists()


def test_raw_files_without_rows(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    for name, body in RAW.items():
        (tmp_path / "raw" / f"{name}.tsv").write_text(body.splitlines()[0] + "\n")
    report = run_job(spark, f"{tmp_path}/raw", f"{tmp_path}/out")
    assert {tuple(r)[1:] for r in report.collect()} == {(0, 0, 0, 0.0)}


def test_write_tables(spark, done, tmp_path):
    t = read_tables(spark, f"{done[0]}/out/tables", unique_links=True)
    copy = write_tables(t, str(tmp_path / "copy"))
    assert copy.unique_links
    assert sorted(copy.patents.collect()) == sorted(t.patents.collect())
