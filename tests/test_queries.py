"""Results worked out by hand, and rewritten queries against their plain SQL forms."""

import json
from dataclasses import replace

import pytest
import samples
from compare import bag

from linkloom.plans import queries as q
from linkloom.plans import reports as r
from linkloom.plans import trends as v
from linkloom.tables import run_sql


def rows(frame):
    return [tuple(x) for x in frame.collect()]


@pytest.fixture(scope="module", params=[True, False], ids=["unique", "any"])
def t(spark, request):
    return samples.ties(spark, request.param)


def test_top_inventors_cut_ties_by_id(t):
    assert rows(q.q1_top_inventors(t, 4)) == [
        ("Ann", "US", 3), ("Ann", "US", 3), ("Bo", "DE", 3), ("Cy", "DE", 1),
    ]


def test_top_companies(t):
    assert rows(q.q2_top_companies(t)) == [("Acme", "US", 2), ("Bolt", "DE", 2)]


def test_country_share_is_of_all_links(t):
    # 13 links; US p1 p2 p3, DE p1 p2 p5; FR has none; unknown and null do not count
    assert rows(q.q3_country_share(t)) == [("DE", 3, 23.08), ("US", 3, 23.08)]


def test_yearly(t):
    assert rows(q.q4_yearly_trend(t)) == [(2018, 2), (2020, 2)]


def test_patent_detail_fans_out_and_keeps_unlinked_patents(t):
    got = [(x.patent_id, x.year, x.inventor_name, x.company_name) for x in q.q5_patent_detail(t).collect()]
    p1 = [("p1", 2018, n, c) for n in ("Ann", "Ann", "Bo", "Cy", "Di", "Ed") for c in ("Acme", "Bolt")]
    assert got == [
        ("p3", 2020, "Ann", None), ("p3", 2020, "Ann", None), ("p4", 2020, None, "Bolt"),
        *p1,
        ("p2", 2018, "Ann", "Acme"), ("p2", 2018, "Ann", "Acme"), ("p2", 2018, "Bo", "Acme"),
        ("p2", 2018, "Gus", "Acme"), ("p5", None, "Bo", None),
    ]


def test_country_year_activity_counts_links(t):
    assert rows(q.q6_country_year_activity(t)) == [
        ("US", 2020, 2, 2, 1.0), ("US", 2018, 3, 5, 1.67), ("DE", 2018, 2, 3, 1.5),
    ]


def test_ranks(t):
    assert rows(q.q7_ranked_inventors(t)) == [
        (1, 1, "Ann", "US", 3, 23.0769), (1, 1, "Ann", "US", 3, 23.0769),
        (1, 1, "Bo", "DE", 3, 23.0769), (4, 2, "Cy", "DE", 1, 7.6923),
        (4, 2, "Di", "US", 1, 7.6923), (4, 1, "Ed", "UNKNOWN", 1, 7.6923),
        (4, 1, "Gus", None, 1, 7.6923),
    ]
    assert r.r_ranked_inventors(t).columns == ["rank", "name", "country", "patent_count", "pct_of_total"]


def test_summary(t):
    summary = json.loads(r.as_json(r.r_summary(t, 2)).collect()[0].summary)
    assert summary == {
        "total_patents": 5,
        "top_inventors": [
            {"rank": 1, "name": "Ann", "country": "US", "patents": 3},
            {"rank": 2, "name": "Ann", "country": "US", "patents": 3},
        ],
        "top_companies": [
            {"rank": 1, "company": "Acme", "country": "US", "patents": 2},
            {"rank": 2, "company": "Bolt", "country": "DE", "patents": 2},
        ],
        "top_countries": [
            {"rank": 1, "country": "DE", "patents": 3, "share_pct": 23.08},
            {"rank": 2, "country": "US", "patents": 3, "share_pct": 23.08},
        ],
        "yearly_trends": [{"year": 2018, "patents": 2}, {"year": 2020, "patents": 2}],
    }


def test_chart_of_inventors_is_smallest_first(t):
    assert rows(v.v_top_inventors(t, 4)) == [("Cy", 1), ("Bo", 3), ("Ann", 3), ("Ann", 3)]


def test_other_is_the_rest_of_the_pool(spark):
    lands = [f"L{i:02}" for i in range(11)]
    inventors = [(f"i{i:02}", "n", land) for i, land in enumerate(lands)]
    # country i has 20 - i patents
    links = [(f"p{n}", f"i{i:02}") for i in range(11) for n in range(20 - i)]
    t = samples.build(spark, [], inventors, [], links, [])
    first = [(lands[i], 20 - i) for i in range(7)]
    assert [x[:2] for x in rows(v.v_country_share_other(t))] == [*first, ("Other", 13)]
    rest = rows(v.v_country_share_other(t, pool=None))
    assert [x[:2] for x in rest] == [*first, ("Other", 13 + 12 + 11 + 10)]
    assert rest[0][2] == round(20 / 165 * 100, 1)
    assert rows(v.v_country_share_other(t, keep=11, pool=None))[-1] == ("Other", 0, 0.0)


def test_trend_has_zeros_and_long_form_has_none(t):
    wide = v.v_country_trend(t)
    assert wide.dtypes == [("year", "int"), ("DE", "bigint"), ("US", "bigint")]
    assert rows(wide) == [(2018, 2, 2), (2020, 0, 1)]
    assert sorted(rows(v.v_country_trend_long(t))) == [
        (2018, "DE", 2), (2018, "US", 2), (2020, "US", 1),
    ]
    assert rows(v.d_country_trend(t, 2019, 2021)) == [(2020, 0, 1)]


def test_top_countries_go_by_links(t):
    # US has 7 links, DE 4, FR none
    assert rows(v.v_top5_countries(t)) == [("US",), ("DE",)]


def test_overview(t):
    assert rows(v.d_overview_totals(t)) == [(5, 8, 2, 3)]


def test_pages_number_rows_by_place(t):
    assert rows(v.d_top_inventors(t, 2018, 2018, 3)) == [
        (1, "Ann", "US", 2), (2, "Ann", "US", 2), (3, "Bo", "DE", 2),
    ]
    assert rows(v.d_top_companies(t, 2018, 2019)) == [(1, "Acme", "US", 2), (2, "Bolt", "DE", 1)]
    assert rows(v.d_countries(t, 2020, 2020)) == [(1, "US", 1, 7.69)]
    assert v.d_countries(t).columns == ["Rank", "country", "patents", "share_pct"]


def test_growth_is_over_the_previous_year_present(spark):
    years = [2015] * 2 + [2016] * 3 + [2018] * 6
    t = samples.build(spark, [samples.patent(f"p{i}", y) for i, y in enumerate(years)], [], [], [], [])
    assert rows(v.d_yoy_growth(t, 2015, 2020)) == [(2015, 2, None), (2016, 3, 50.0), (2018, 6, 100.0)]


def test_empty_tables(spark):
    t = samples.empty(spark)
    for fn in (
        q.q1_top_inventors, q.q2_top_companies, q.q3_country_share, q.q4_yearly_trend,
        q.q5_patent_detail, q.q6_country_year_activity, q.q7_ranked_inventors, v.v_top5_countries,
        v.v_country_trend, v.v_country_trend_long, v.d_yoy_growth, v.d_top_inventors, v.d_countries,
    ):
        assert fn(t).count() == 0
    assert rows(v.d_overview_totals(t)) == [(0, 0, 0, 0)]
    assert rows(r.r_total_patents(t)) == [(0,)]
    for pool in (8, None):
        assert rows(v.v_country_share_other(t, pool=pool)) == [("Other", 0, None)]
    assert r.r_summary(t).collect()[0].asDict() == {
        "total_patents": 0, "top_inventors": [], "top_companies": [], "top_countries": [],
        "yearly_trends": [],
    }


PLAIN = {
    q.q1_top_inventors: """
        SELECT name, country, patent_count FROM (
            SELECT inventor_id, name, country, count(DISTINCT patent_id) AS patent_count
            FROM patent_inventors JOIN inventors USING (inventor_id) GROUP BY ALL)
        ORDER BY patent_count DESC, inventor_id LIMIT 20""",
    q.q3_country_share: """
        SELECT country, count(DISTINCT patent_id) AS patent_count,
               round(count(DISTINCT patent_id) * 100D / (SELECT count(*) FROM patent_inventors), 2)
                   AS share_pct
        FROM patent_inventors JOIN inventors USING (inventor_id) WHERE country <> 'UNKNOWN'
        GROUP BY country ORDER BY patent_count DESC, country LIMIT 20""",
    q.q5_patent_detail: """
        SELECT p.patent_id, title, filing_date, year, i.name AS inventor_name,
               i.country AS inventor_country, c.name AS company_name
        FROM patents p LEFT JOIN patent_inventors l ON p.patent_id = l.patent_id
        LEFT JOIN inventors i ON l.inventor_id = i.inventor_id
        LEFT JOIN patent_companies m ON p.patent_id = m.patent_id
        LEFT JOIN companies c ON m.company_id = c.company_id
        ORDER BY year DESC, p.patent_id, l.inventor_id, m.company_id LIMIT 500""",
    q.q6_country_year_activity: """
        SELECT country, year, count(DISTINCT inventor_id) AS active_inventors,
               count(*) AS total_patents,
               round(count(*) * 1D / count(DISTINCT inventor_id), 2) AS patents_per_inventor
        FROM patent_inventors JOIN inventors USING (inventor_id) JOIN patents USING (patent_id)
        WHERE year IS NOT NULL AND country <> 'UNKNOWN' GROUP BY country, year
        ORDER BY year DESC, total_patents DESC, country LIMIT 100""",
    q.q7_ranked_inventors: """
        SELECT global_rank, country_rank, name, country, patent_count, pct_of_total FROM (
            SELECT *, rank() OVER (ORDER BY patent_count DESC) AS global_rank,
                   dense_rank() OVER (PARTITION BY country ORDER BY patent_count DESC) AS country_rank,
                   round(patent_count * 100D / sum(patent_count) OVER (), 4) AS pct_of_total
            FROM (SELECT inventor_id, name, country, count(DISTINCT patent_id) AS patent_count
                  FROM patent_inventors JOIN inventors USING (inventor_id) GROUP BY ALL))
        ORDER BY global_rank, inventor_id LIMIT 50""",
    v.v_top5_countries: """
        SELECT country FROM patent_inventors JOIN inventors USING (inventor_id)
        WHERE country <> 'UNKNOWN' GROUP BY country ORDER BY count(*) DESC, country LIMIT 5""",
}


@pytest.mark.parametrize("fn", PLAIN, ids=lambda f: f.__name__)
@pytest.mark.parametrize("orphans", [False, True])
def test_rewritten_equals_plain_sql(spark, fn, orphans):
    t = samples.skewed(spark, seed=7, orphans=orphans)
    t.register_views()
    plain, ours = run_sql(spark, PLAIN[fn]), fn(t)
    assert ours.columns == plain.columns
    assert bag(ours.columns, rows(ours)) == bag(plain.columns, rows(plain))


def test_patent_detail_with_a_limit_inside_one_patent(spark):
    """The limit falls among the many pairs of one patent."""
    inventors = [(f"i{n:03}", f"n{n}", "US") for n in range(60)]
    companies = [(f"c{n:03}", f"f{n}", "US") for n in range(40)]
    t = samples.build(
        spark, [samples.patent("p", 2020), samples.patent("q", 2021)], inventors, companies,
        [("p", i[0]) for i in inventors], [("p", c[0]) for c in companies],
    )
    got = [(x.patent_id, x.inventor_name, x.company_name) for x in q.q5_patent_detail(t, 50).collect()]
    pairs = [("p", f"n{i}", f"f{c}") for i in range(60) for c in range(40)]
    assert got == [("q", None, None), *pairs][:50]
    assert q.q5_patent_detail(t, 2000).count() == 2000
    assert q.q5_patent_detail(t, 5000).count() == 60 * 40 + 1


def test_repeated_links_count_once(spark):
    once = samples.skewed(spark, seed=3)
    twice = samples.skewed(spark, seed=3, unique=False)
    assert twice.patent_inventors.count() == once.patent_inventors.count() + 200
    for fn in (q.q1_top_inventors, q.q2_top_companies, v.v_country_trend, v.v_country_share_other):
        assert rows(fn(twice)) == rows(fn(once))


def test_results_do_not_depend_on_partitions(spark):
    t = samples.skewed(spark, seed=5)
    spread = replace(t, **{n: f.repartition(13) for n, f in t.items()})
    for fn in (q.q3_country_share, q.q5_patent_detail, q.q7_ranked_inventors, v.v_country_trend):
        assert rows(fn(t)) == rows(fn(spread))


def test_yearly_counts_sum_to_the_total(spark):
    t = samples.skewed(spark, seed=9)
    dated = sum(x.patent_count for x in q.q4_yearly_trend(t).collect())
    undated = t.patents.where("year IS NULL").count()
    assert dated + undated == r.r_total_patents(t).collect()[0].n


def test_sql_takes_named_values(spark):
    samples.ties(spark).register_views()
    found = run_sql(spark, "SELECT name FROM inventors WHERE country = :c", c="FR' OR '1' = '1")
    assert found.count() == 0
    assert rows(run_sql(spark, "SELECT name FROM inventors WHERE country = :c", c="FR")) == [("Flo",)]
