"""The year cube, kept results, and versions of the stored tables."""

import re

import pytest
from pyspark.sql import functions as F
from samples import empty, skewed, ties
from test_plans import as_on_a_cluster, final_plan, stored  # noqa: F401

from linkloom.checks import registry
from linkloom.operators import cleaning, cube
from linkloom.plans import job, trends as v
from linkloom.plans import queries as q
from linkloom.plans import reports as r
from linkloom.plans.cache import PAGES, Pages, ResultCache
from linkloom.sources import files
from linkloom.sources.parquet import read_tables, write_tables
from linkloom.sources.snapshots import Snapshots

SMALL = "/root/testdata/sf0.001"
FROM_CUBE = [
    q.q1_top_inventors, q.q2_top_companies, q.q3_country_share, q.q4_yearly_trend,
    q.q7_ranked_inventors, r.r_summary, v.v_country_share_other, v.v_top5_countries,
    v.v_country_trend_places, v.v_country_trend_long, v.v_top_inventors, v.v_top_companies,
]
RANGES = [(2011, 2016), (2018, 2018), (1990, 2100), (2030, 2020)]


@pytest.mark.parametrize("make", [
    ties, empty, lambda s: skewed(s, 3, orphans=True), lambda s: skewed(s, 4, unique=False),
], ids=["ties", "empty", "orphans", "repeated"])
def test_the_cube_gives_what_links_give(spark, tmp_path, make):
    """Also for links to nothing, patents without a year and repeated links."""
    t = make(spark)
    cubed = cube.write(t, str(tmp_path))
    for fn in FROM_CUBE:
        assert fn(cubed).collect() == fn(t).collect() or (
            sorted(map(str, fn(cubed).collect())) == sorted(map(str, fn(t).collect()))
        ), fn.__name__
    for name, page in PAGES.items():
        for years in RANGES if name != "overview" else [()]:
            got, want = (sorted(map(str, page(x, *years).collect())) for x in (cubed, t))
            assert got == want, (name, years)


@pytest.mark.parametrize("page", [p for p in PAGES if p != "overview"])
def test_pages_read_no_links(stored, as_on_a_cluster, tmp_path_factory, page):  # noqa: F811
    t = cube.write(stored, str(tmp_path_factory.mktemp("cube")))
    plan = final_plan(PAGES[page](t, 2003, 2006))
    assert "patent_inventors" not in plan and "patent_companies" not in plan
    if page in ("top_inventors", "top_companies", "countries"):
        filters = re.findall(r"PartitionFilters: \[(.*?)\], Pushed", plan)
        assert any("2003" in f and "2006" in f for f in filters)


def test_the_wide_trend_is_one_lazy_plan(stored, as_on_a_cluster):  # noqa: F811
    tracker = stored.patents.sparkSession.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    frame = v.v_country_trend_places(stored, 3)
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert frame.columns == ["year", "country_1", "country_2", "country_3"]


def test_results_are_kept_until_a_table_changes(spark, tmp_path):
    store = str(tmp_path / "store")
    write_tables(ties(spark), store)
    first = Pages.over(spark, store)
    made = first.show("top_inventors", year_from=2018, year_to=2020)
    again = first.show("top_inventors", year_to=2020, year_from=2018, top_n=20)
    assert sorted(again.collect()) == sorted(made.collect())
    assert again.inputFiles() and all("/results/" in f for f in again.inputFiles())
    assert first.cache.path("top_inventors", {"year_from": 2018}) != first.cache.path("top_inventors", {})
    # A rebuild has a version, so results, of its own.
    t = read_tables(spark, store)
    t = write_tables(type(t)(**{**dict(t.items()), "patent_inventors": t.patent_inventors.limit(0)}), store)
    second = Pages.over(spark, store)
    assert second.show("top_inventors", year_from=2018, year_to=2020).count() == 0
    assert sorted(first.show("top_inventors", year_from=2018, year_to=2020).collect()) == sorted(made.collect())
    second.cache.drop_others()
    assert files.children(spark, f"{store}/results") == [t.version]


def test_a_result_cut_short_is_made_anew(spark, tmp_path):
    cache, made = ResultCache(spark, str(tmp_path), "v1"), []

    def build():
        made.append(1)
        return spark.range(3)

    path = cache.path("x", {"a": 1})
    spark.range(99).write.parquet(path)
    files.delete(spark, f"{path}/_SUCCESS")
    for _ in range(2):
        assert cache.get("x", build, a=1).count() == 3
    assert len(made) == 1


def test_kept_results_follow_the_files(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a")
    one = files.version_of(spark, [f"{tmp_path}/a"])
    assert files.version_of(spark, [f"{tmp_path}/a"]) == one
    spark.range(4).write.mode("append").parquet(f"{tmp_path}/a")
    assert files.version_of(spark, [f"{tmp_path}/a"]) != one
    twice = registry.QUERIES["d_cached_countries"](spark, SMALL)
    assert twice.inputFiles() and all("/results/" in f for f in twice.inputFiles())


def test_readers_see_whole_versions_only(spark, tmp_path):
    store = str(tmp_path)
    old = write_tables(ties(spark), store)
    before = sorted(old.patents.collect())
    snapshots = Snapshots(spark, store)
    begun = snapshots.begin()
    spark.range(1).write.parquet(f"{snapshots.folder(begun)}/patents")
    assert sorted(read_tables(spark, store).patents.collect()) == before
    new = write_tables(empty(spark), store)
    assert new.version != old.version and read_tables(spark, store).patents.count() == 0
    # Who began with the old version goes on reading it, until it is dropped.
    assert sorted(old.patents.collect()) == before
    snapshots.drop_old(keep=1)
    assert files.children(spark, f"{store}/versions") == sorted([begun, new.version])
    assert snapshots.current() == new.version


def test_a_job_that_dies_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    from test_job import RAW

    raw = tmp_path / "raw"
    raw.mkdir()
    for name, body in RAW.items():
        (raw / f"{name}.tsv").write_text(body)
    job.run_job(spark, str(raw), f"{tmp_path}/out", csv=False)
    before = {n: sorted(f.collect()) for n, f in read_tables(spark, f"{tmp_path}/out/tables").items()}
    (raw / "g_patent.tsv").write_text(RAW["g_patent"] + "P9\tutility\t2020-07-08\tNA\tnew\n")

    def dies(*args):
        raise RuntimeError("the cluster is gone")

    for step in ("clean_patent_inventors", "clean_patent_companies"):
        with monkeypatch.context() as m, pytest.raises(RuntimeError):
            m.setattr(cleaning, step, dies)
            job.run_job(spark, str(raw), f"{tmp_path}/out", csv=False)
        after = {n: sorted(f.collect()) for n, f in read_tables(spark, f"{tmp_path}/out/tables").items()}
        assert after == before
    job.run_job(spark, str(raw), f"{tmp_path}/out", csv=False)
    ids = read_tables(spark, f"{tmp_path}/out/tables").patents.select(F.col("patent_id"))
    assert "P9" in {x[0] for x in ids.collect()}
