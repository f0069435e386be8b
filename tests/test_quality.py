import pytest
import samples

from linkloom.operators import quality


def test_counts_of_broken_rules(spark):
    t = samples.build(
        spark,
        [samples.patent("p", 2020), samples.patent("p", 2021), ("q", None, None, None, None),
         (None, "t", None, None, None), (None, "t", None, None, None)],
        [("i", "n", "US"), (None, "n", "US")],
        [("c", None, None)],
        [("p", "i"), ("p", "i"), ("p", "gone"), ("q", "gone"), ("zz", "i"), (None, "i")],
        [("p", "c"), ("p", None)],
        unique=False,
    )
    found = {(r.table, r.check): r.violations for r in quality.integrity(t).collect()}
    broken = {rule: n for rule, n in found.items() if n}
    assert broken == {
        ("patents", "unique(patent_id)"): 1,
        ("patents", "not_null(patent_id)"): 2,
        ("patents", "not_null(title)"): 1,
        ("inventors", "not_null(inventor_id)"): 1,
        ("companies", "not_null(name)"): 1,
        ("patent_inventors", "unique(patent_id, inventor_id)"): 1,
        ("patent_inventors", "not_null(patent_id)"): 1,
        ("patent_companies", "not_null(company_id)"): 1,
        ("patent_inventors", "references(patent_id -> patents)"): 1,
        ("patent_inventors", "references(inventor_id -> inventors)"): 2,
    }
    assert len(found) == 19
    with pytest.raises(quality.IntegrityError, match=r"patent_inventors references\(inventor_id"):
        quality.require_integrity(t)


def test_sound_and_empty_tables_pass(spark):
    for t in (samples.ties(spark), samples.empty(spark)):
        quality.require_integrity(t)
        assert quality.integrity(t).where("violations <> 0").count() == 0


def test_null_entity_key_is_reported_but_not_fatal(spark):
    t = samples.build(spark, [], [(None, "n", "US")], [], [], [])
    quality.require_integrity(t)
    assert quality.integrity(t).where("violations = 1").count() == 1


def test_drop_report(spark):
    counts = quality.counts_frame(spark, [("a", 3, 2), ("b", 0, 0), ("c", 8, 8)])
    assert [tuple(r) for r in quality.drop_report(counts).collect()] == [
        ("a", 3, 2, 1, 33.3), ("b", 0, 0, 0, 0.0), ("c", 8, 8, 0, 0.0),
    ]


def test_one_shuffle_for_each_key_domain(spark):
    plan = quality.integrity(samples.skewed(spark, 2))._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1] if "== Initial Plan ==" in plan else plan
    assert initial.count("Exchange hashpartitioning") == 5 and "Join" not in initial


def test_reasons_add_up(spark):
    """Rejects and kept rows are all rows, each under its first reason."""
    from linkloom.operators import cleaning
    from linkloom.sources.delimited import ORDINAL

    rows = [
        ("p1", "2020-01-01", "t"), ("p1", "2020-01-02", "u"), ("p1", None, "v"), (None, None, None),
        ("p2", "2020-01-01", " "), ("p3", "1900-01-01", "t"), ("p4", "never", "t"), ("p5", "2021-5-6", "t"),
    ]
    raw = spark.createDataFrame(
        [(i, *r, "") for i, r in enumerate(rows)],
        f"{ORDINAL} long, patent_id string, date string, title string, abstract string")
    stage = cleaning.patents_stage(raw)
    got = {r.reason: r.rows for r in quality.stage_rejects(stage, "patents").collect()}
    assert got == {"no id": 1, "no title": 1, "bad date": 2, "year out of range": 1, "copy": 1}
    assert sum(got.values()) + stage.where("_valid").count() == len(rows)
    patents = spark.createDataFrame([("p1",), ("p2",)], "patent_id string")
    people = spark.createDataFrame([("i1",)], "inventor_id string")
    links = spark.createDataFrame(
        [("p1", "i1"), ("p1", "i1"), ("p2", "i2"), ("zz", "i1"), ("zz", "i2"), (None, "i1"), ("p1", None)],
        "patent_id string, inventor_id string")
    stage = cleaning.patent_inventors_stage(links, patents, people)
    got = {r.reason: r.rows for r in quality.stage_rejects(stage, "patent_inventors").collect()}
    assert got == {"no key": 2, "unknown inventor": 2, "unknown patent": 1, "copy": 1}
    kept = stage.where("_valid").select("patent_id", "inventor_id")
    assert [tuple(r) for r in kept.collect()] == [("p1", "i1")]
