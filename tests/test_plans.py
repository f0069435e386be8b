"""Physical plans: what is read, what is shuffled, and what becomes of a frequent key."""

import re

import pytest
from pyspark.sql import functions as F

from linkloom.operators import cleaning, cube, quality
from linkloom.plans import queries as q
from linkloom.plans import reports as r
from linkloom.plans import trends as v
from linkloom.sources import files, star
from linkloom.sources.delimited import ORDINAL
from linkloom.sources.parquet import by_year, write_tables
from linkloom.tables import Tables

SF = "/root/testdata/sf0.001"


def final_plan(frame) -> str:
    """The plan that ran, subqueries included, without the plans AQE started from."""
    frame.collect()
    lines, skip = [], None
    for line in frame._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = re.search(r"[A-Za-z*=(]|$", line).start()
        if skip is not None and depth <= skip:
            skip = None
        if skip is None and "== Initial Plan ==" in line:
            skip = depth - 1
        if skip is None:
            lines.append(line)
    return "\n".join(lines)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Stored tables in which one inventor holds a third of the links, one patent another."""
    store = str(tmp_path_factory.mktemp("store"))
    n = 60_000
    ids = spark.range(n)
    number = F.col("id").cast("string")
    year = (F.lit(2000) + F.col("id") % 20).cast("int")
    links = ids.select(F.concat(F.lit("p"), number).alias("patent_id"),
                       F.concat(F.lit("i"), (F.col("id") % 5000).cast("string")).alias("inventor_id"))
    hot_inventor = ids.select(
        F.concat(F.lit("p"), number).alias("patent_id"), F.lit("i1").alias("inventor_id"))
    hot_patent = ids.select(
        F.lit("p7").alias("patent_id"), F.concat(F.lit("i"), number).alias("inventor_id"))
    # Several files, as AQE splits a partition between the outputs of map tasks.
    links = links.union(hot_inventor).union(hot_patent).distinct().repartition(8)
    t = Tables(
        patents=ids.select(
            F.concat(F.lit("p"), number).alias("patent_id"), F.lit("t").alias("title"),
            F.lit("long text").alias("abstract"), F.make_date(year, F.lit(1), F.lit(1)).alias("filing_date"),
            year.alias("year")),
        inventors=ids.select(
            F.concat(F.lit("i"), number).alias("inventor_id"), F.concat(F.lit("n"), number).alias("name"),
            F.element_at(F.array(*map(F.lit, ["US", "DE", "FR", "JP", "UNKNOWN", "GB"])),
                         (F.col("id") % 6 + 1).cast("int")).alias("country")),
        companies=ids.limit(10).select(
            F.concat(F.lit("c"), number).alias("company_id"), F.lit("n").alias("name"),
            F.lit("US").alias("country")),
        patent_inventors=links,
        patent_companies=ids.select(F.concat(F.lit("p"), number).alias("patent_id"), F.lit("c1").alias("company_id")),
        unique_links=True,
    )
    return write_tables(t, store)


@pytest.fixture
def as_on_a_cluster(conf):
    """No table is small enough to broadcast, and a few kilobytes count as skew."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50k")
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.files.openCostInBytes", "64m")


QUERIES = [
    q.q1_top_inventors, q.q2_top_companies, q.q3_country_share, q.q4_yearly_trend,
    q.q5_patent_detail, q.q6_country_year_activity, q.q7_ranked_inventors, r.r_summary,
    v.v_country_share_other, v.v_top5_countries, v.v_country_trend, v.d_overview_totals,
    v.d_top_inventors, v.d_top_companies, v.d_countries, v.d_yoy_growth, quality.integrity,
]


@pytest.mark.parametrize("fn", QUERIES, ids=lambda f: f.__name__)
def test_no_cross_joins_and_no_python(stored, as_on_a_cluster, fn):
    plan = final_plan(fn(stored))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "ArrowEval" not in plan


def broadcasts(plan: str) -> int:
    return len(re.findall(r"BroadcastExchange", plan))


@pytest.mark.parametrize("fn", [f for f in QUERIES if f is not q.q5_patent_detail],
                         ids=lambda f: f.__name__)
def test_nothing_is_broadcast_by_hint(stored, as_on_a_cluster, fn):
    assert broadcasts(final_plan(fn(stored))) == 0


def test_patent_detail_has_one_shape_for_every_limit(stored, as_on_a_cluster):
    def shape(k):
        return re.findall(r"\w*Join|\w*Exchange|TakeOrdered\w*", final_plan(q.q5_patent_detail(stored, k)))

    assert shape(500) == shape(501)


@pytest.mark.parametrize("fn", [q.q3_country_share, v.v_country_trend, v.v_country_share_other],
                         ids=lambda f: f.__name__)
def test_joins_of_single_links_split_a_frequent_inventor(stored, as_on_a_cluster, fn):
    plan = final_plan(fn(stored))
    assert "SortMergeJoin(skew=true) [inventor_id" in plan
    if fn is not v.v_country_trend:  # which finds its countries by counted links, a row per inventor
        assert "SortMergeJoin [inventor_id" not in plan


@pytest.mark.parametrize("fn", [q.q6_country_year_activity, v.d_top_inventors, v.d_countries],
                         ids=lambda f: f.__name__)
def test_joins_of_single_links_split_a_frequent_patent(stored, as_on_a_cluster, fn):
    assert "skew=true" in final_plan(fn(stored))


def test_link_cleaning_splits_frequent_keys(stored, as_on_a_cluster):
    raw = stored.patent_inventors
    clean = cleaning.clean_patent_inventors(raw, stored.patents, stored.inventors)
    plan = final_plan(clean)
    assert plan.count("skew=true") == 2
    assert clean.count() == raw.count()


@pytest.mark.parametrize("fn", [q.q1_top_inventors, q.q7_ranked_inventors, v.v_top5_countries],
                         ids=lambda f: f.__name__)
def test_links_are_counted_before_they_are_joined(stored, as_on_a_cluster, fn):
    """The links' only shuffle carries one row per entity and task, so nothing is skewed."""
    plan = final_plan(fn(stored))
    assert re.search(r"Exchange hashpartitioning\(inventor_id.*\n.*partial_count", plan)
    assert "SortMergeJoin" in plan and "skew=true" not in plan


def test_a_range_of_years_reads_only_its_partitions(stored):
    plan = final_plan(v.d_yearly(stored, 2003, 2004))
    filters = re.search(r"PartitionFilters: \[(.*?)\], Pushed", plan).group(1)
    assert "2003" in filters and "2004" in filters
    assert "ReadSchema: struct<>" in plan


def test_only_needed_columns_are_read(stored):
    for fn in QUERIES:
        if fn is not q.q5_patent_detail:
            assert not re.search(r"ReadSchema: struct<[^>]*abstract", final_plan(fn(stored)))
    assert "ReadSchema: struct<country:string>" in final_plan(v.d_overview_totals(stored))


def test_country_filters_reach_the_scan(stored):
    assert "Not(EqualTo(country,UNKNOWN))" in final_plan(q.q3_country_share(stored))


def test_ranks_see_only_the_top_rows(stored, as_on_a_cluster):
    plan = final_plan(q.q7_ranked_inventors(stored))
    for window in re.finditer(r"Window \[(rank|dense_rank)", plan):
        assert "TakeOrderedAndProject" in plan[window.start():]


def test_total_and_counts_share_one_shuffle(spark, as_on_a_cluster):
    plan = final_plan(q.q7_ranked_inventors(star.model_tables(spark, SF)))
    assert "ReusedExchange" in plan


def test_copies_are_folded_before_the_shuffle(spark):
    raw = spark.range(1000).select(
        F.lit("hot").alias("patent_id"), F.lit("t").alias("title"), F.lit("a").alias("abstract"),
        F.lit("2020-01-01").alias("date"), F.col("id").alias(ORDINAL))
    plan = final_plan(cleaning.clean_patents(raw))
    assert re.search(r"Exchange.*\n.*partial_min", plan)
    assert "Window" not in plan


def test_a_large_year_is_written_by_several_tasks(spark, conf, tmp_path):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    rows = spark.range(200_000).select(
        F.col("id").cast("string").alias("patent_id"), F.md5(F.col("id").cast("string")).alias("title"),
        F.lit(None).cast("string").alias("abstract"), F.to_date(F.lit("2020-01-01")).alias("filing_date"),
        F.when(F.col("id") < 190_000, 2020).otherwise(2000 + F.col("id") % 10).cast("int").alias("year"))
    by_year(rows.repartition(8)).write.partitionBy("year").parquet(str(tmp_path / "p"))
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "p").glob("year=*")}
    assert files.pop("year=2020") > 3
    assert set(files.values()) == {1}


def dealt_by_number(plan: str) -> list[int]:
    return [int(n) for n in re.findall(r"hashpartitioning\([^)]*, (\d+)\), REPARTITION_BY_NUM", plan)]


def test_tasks_of_the_cube_grow_with_the_files(stored, as_on_a_cluster, monkeypatch):
    """Distinct pairs of a country and a patent are held by more tasks, not by larger ones."""
    size = files.size_of(cube.build(stored)["country_years"])
    assert size > 500_000
    for tasks in (3, 50):
        monkeypatch.setattr(files, "_EACH", -(-size // tasks))
        assert dealt_by_number(final_plan(cube.build(stored)["country_years"])) == [tasks]


def test_tasks_of_integrity_grow_with_the_files(spark, monkeypatch):
    size = files.size_of(star.model_tables(spark, SF).patent_inventors)
    for tasks in (3, 50):
        monkeypatch.setattr(files, "_EACH", -(-size // tasks))
        found = dealt_by_number(final_plan(quality.integrity(star.model_tables(spark, SF))))
        assert found and {*found} == {tasks}


def test_frames_without_files_are_spread_too(spark):
    frame = spark.range(10).union(spark.range(10))
    assert files.size_of(frame) == 0
    assert files.spread(frame, "id").distinct().count() == 10
