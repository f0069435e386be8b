r"""DuckDB SQL that gives the same rows as the registered queries.

DuckDB's ``\s`` is ASCII, so white space is spelled out. Descending order puts nulls last
and ascending order puts them first wherever a limit follows.
"""

from __future__ import annotations

from linkloom.checks.registry import YEAR_FROM, YEAR_TO
from linkloom.sources.star import RAW_ORDER, RAW_SQL

_MODEL = """
patents AS (
    SELECT o_orderkey AS patent_id, o_orderpriority AS title,
           strftime(o_orderdate, '%Y-%m-%d') AS filing_date,
           CAST(year(o_orderdate) AS INTEGER) AS "year"
    FROM orders
),
inventors AS (
    SELECT s_suppkey AS inventor_id, s_name AS name,
           CASE WHEN n_nationkey = 0 THEN 'UNKNOWN' ELSE n_name END AS country
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
companies AS (
    SELECT c_custkey AS company_id, c_name AS name,
           CASE WHEN n_nationkey = 0 THEN 'UNKNOWN' ELSE n_name END AS country
    FROM customer JOIN nation ON c_nationkey = n_nationkey
),
patent_inventors AS (
    SELECT DISTINCT l_orderkey AS patent_id, l_suppkey AS inventor_id FROM lineitem
),
patent_companies AS (
    SELECT o_orderkey AS patent_id, o_custkey AS company_id FROM orders
),
ilinks AS (SELECT * FROM patent_inventors JOIN inventors USING (inventor_id)),
clinks AS (SELECT * FROM patent_companies JOIN companies USING (company_id)),
sizes AS (SELECT CAST(count(*) AS DOUBLE) AS n_links FROM patent_inventors)
"""

_RANGE = f'"year" BETWEEN {YEAR_FROM} AND {YEAR_TO}'


def _m(body: str, more: str = "") -> str:
    """A query on the model tables, with further common tables if any."""
    return f"WITH {_MODEL}{more} {body}"


def _entity_top(links: str, key: str, name: str, count: str, k: int) -> str:
    return f"""
        SELECT any_value(name) AS {name}, any_value(country) AS country,
               count(DISTINCT patent_id) AS {count}
        FROM {links} GROUP BY {key} ORDER BY {count} DESC, {key} LIMIT {k}
    """


def _country_top(count: str) -> str:
    return f"""
        SELECT country, count(DISTINCT patent_id) AS {count},
               round(count(DISTINCT patent_id) * 100.0::DOUBLE / any_value(n_links), 2) AS share_pct
        FROM ilinks, sizes WHERE country <> 'UNKNOWN'
        GROUP BY country ORDER BY {count} DESC, country LIMIT 20
    """


def _yearly(count: str, where: str = '"year" IS NOT NULL') -> str:
    return f'SELECT "year", count(*) AS {count} FROM patents WHERE {where} GROUP BY ALL ORDER BY 1'


def _ranked(columns: str) -> str:
    return f"""
        SELECT {columns} FROM (
            SELECT *, CAST(rank() OVER (ORDER BY n DESC) AS INTEGER) AS global_rank,
                   CAST(dense_rank() OVER (PARTITION BY country ORDER BY n DESC) AS INTEGER)
                       AS country_rank,
                   n AS patent_count,
                   round(n * 100.0::DOUBLE / sum(n) OVER (), 4) AS pct_of_total
            FROM (SELECT inventor_id, name, country, count(DISTINCT patent_id) AS n
                  FROM ilinks GROUP BY ALL)
        ) ORDER BY global_rank, inventor_id LIMIT 50
    """


def _share_other(pool: str) -> str:
    """"Other" is always there, as 0 where no country is left for it."""
    return _m(
        """
        SELECT country, patents, round(patents * 100.0::DOUBLE / sum(patents) OVER (), 1) AS pct
        FROM (
            SELECT CASE WHEN place <= 7 THEN country ELSE 'Other' END AS country,
                   CAST(sum(n) AS BIGINT) AS patents
            FROM (SELECT place, country, n FROM pool UNION ALL SELECT 8, NULL, 0) GROUP BY 1
        )
        """,
        f""", pool AS (
            SELECT *, row_number() OVER (ORDER BY n DESC, country) AS place
            FROM (SELECT country, count(DISTINCT patent_id) AS n FROM ilinks
                  WHERE country <> 'UNKNOWN' GROUP BY country)
            QUALIFY {pool}
        )""",
    )


def _cells_of(links: str, key: str, where: str = "true") -> str:
    return _m(f"""
        SELECT {key}, "year", count(DISTINCT patent_id) AS patents
        FROM {links} LEFT JOIN patents USING (patent_id) WHERE {where} GROUP BY ALL
    """)


_TOP5 = """, top5 AS (
    SELECT country FROM ilinks WHERE country <> 'UNKNOWN'
    GROUP BY country ORDER BY count(*) DESC, country LIMIT 5
)"""


def _cells(where: str) -> str:
    return f""", cells AS (
        SELECT "year", country, count(DISTINCT patent_id) AS patents
        FROM ilinks JOIN patents USING (patent_id) SEMI JOIN top5 USING (country)
        WHERE {where} GROUP BY ALL
    )"""


def _trend_long(where: str) -> str:
    return _m('SELECT "year", country, patents FROM cells', _TOP5 + _cells(where))


def _trend_wide(where: str) -> str:
    """One column per country, by its place in the alphabet."""
    places = ", ".join(
        f"CAST(coalesce(sum(patents) FILTER (WHERE place = {i}), 0) AS BIGINT) AS country_{i}"
        for i in range(1, 6)
    )
    return _m(
        f"""SELECT "year", {places} FROM cells JOIN (
            SELECT country, row_number() OVER (ORDER BY country) AS place FROM top5
        ) USING (country) GROUP BY "year" """,
        _TOP5 + _cells(where),
    )


def _numbered(links: str, key: str, name: str, n: int) -> str:
    return _m(f"""
        SELECT CAST(row_number() OVER (ORDER BY patents DESC, {key}) AS INTEGER) AS "Rank",
               {name}, country, patents
        FROM (SELECT {key}, name AS {name}, country, count(DISTINCT patent_id) AS patents
              FROM {links} JOIN patents USING (patent_id) WHERE {_RANGE} GROUP BY ALL)
        QUALIFY "Rank" <= {n}
    """)


_SUMMARY = _m(
    """
    SELECT CAST(to_json({
        'total_patents': (SELECT count(*) FROM patents),
        'top_inventors': (SELECT list({'rank': place, 'name': name, 'country': country,
                                       'patents': n} ORDER BY place) FROM people),
        'top_companies': (SELECT list({'rank': place, 'company': name, 'country': country,
                                       'patents': n} ORDER BY place) FROM firms),
        'top_countries': (SELECT list({'rank': place, 'country': country, 'patents': n,
                                       'share_pct': share_pct} ORDER BY place) FROM lands),
        'yearly_trends': (SELECT list({'year': "year", 'patents': n} ORDER BY "year") FROM years)
    }) AS VARCHAR) AS summary
    """,
    """,
    people AS (
        SELECT name, country, count(DISTINCT patent_id) AS n,
               row_number() OVER (ORDER BY count(DISTINCT patent_id) DESC, inventor_id) AS place
        FROM ilinks GROUP BY inventor_id, name, country QUALIFY place <= 10
    ),
    firms AS (
        SELECT name, country, count(DISTINCT patent_id) AS n,
               row_number() OVER (ORDER BY count(DISTINCT patent_id) DESC, company_id) AS place
        FROM clinks GROUP BY company_id, name, country QUALIFY place <= 10
    ),
    lands AS (
        SELECT country, count(DISTINCT patent_id) AS n,
               row_number() OVER (ORDER BY count(DISTINCT patent_id) DESC, country) AS place,
               round(count(DISTINCT patent_id) * 100.0::DOUBLE / any_value(n_links), 2) AS share_pct
        FROM ilinks, sizes WHERE country <> 'UNKNOWN' GROUP BY country QUALIFY place <= 10
    ),
    years AS (SELECT "year", count(*) AS n FROM patents WHERE "year" IS NOT NULL GROUP BY "year")
    """,
)

_WHITE = r"[\s\p{Z}\x0B\x85\x1C-\x1F]+"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WHITE}|{_WHITE}$', '', 'g')"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WHITE}', ' ', 'g'))"


def _raw(name: str) -> str:
    tables = ("lineitem", "customer", "supplier", "nation", "region")
    return f"({RAW_SQL[name].format(**{t: t for t in tables})})"


def _order(name: str) -> str:
    return ", ".join(RAW_ORDER[name])


_CODE = f"upper(substr({_strip('country')}, 1, 2))"
_COUNTRY = f"coalesce(nullif(CASE WHEN country <> 'null' THEN {_CODE} END, ''), 'UNKNOWN')"
_ISO = r"regexp_full_match(date, '\d{4}-\d{1,2}-\d{1,2}')"

_CLEAN = f"""
raw_p AS (SELECT * FROM {_raw("g_patent")}),
raw_i AS (SELECT * FROM {_raw("g_inventor_disambiguated")}),
raw_c AS (SELECT * FROM {_raw("g_assignee_disambiguated")}),
raw_pi AS (SELECT * FROM {_raw("g_patent_inventor")}),
raw_pc AS (SELECT * FROM {_raw("g_patent_assignee")}),
patents AS (
    SELECT patent_id, new_title AS title, nullif(new_abstract, '') AS abstract,
           strftime(day, '%Y-%m-%d') AS filing_date, CAST(year(day) AS INTEGER) AS "year"
    FROM (
        SELECT *, {_collapse('title')} AS new_title, {_collapse('abstract')} AS new_abstract,
               CASE WHEN {_ISO} THEN try_cast(date AS DATE) END AS day
        FROM raw_p
    )
    WHERE new_title <> '' AND year(day) BETWEEN 1976 AND 2030
    QUALIFY row_number() OVER (PARTITION BY patent_id ORDER BY {_order("g_patent")}) = 1
),
inventors AS (
    SELECT coalesce(disambig_inventor_id, raw_id) AS inventor_id, full_name AS name, country
    FROM (
        SELECT disambig_inventor_id, inventor_id AS raw_id, c_custkey, {_COUNTRY} AS country,
               {_strip(f"concat({_strip('name_first')}, ' ', "
                       f"{_strip('''nullif(name_last, 'N/A')''')})")} AS full_name
        FROM raw_i
    )
    WHERE full_name <> ''
    QUALIFY row_number() OVER (
        PARTITION BY coalesce(disambig_inventor_id, raw_id) ORDER BY c_custkey) = 1
),
companies AS (
    SELECT assignee_id AS company_id, {_strip('organization')} AS name, {_COUNTRY} AS country
    FROM raw_c WHERE {_strip('organization')} <> ''
    QUALIFY row_number() OVER (PARTITION BY assignee_id ORDER BY s_suppkey) = 1
),
patent_inventors AS (
    SELECT DISTINCT patent_id, inventor_id
    FROM (SELECT patent_id, coalesce(disambig_inventor_id, inventor_id) AS inventor_id FROM raw_pi)
    WHERE patent_id IN (SELECT patent_id FROM patents)
      AND inventor_id IN (SELECT inventor_id FROM inventors)
),
patent_companies AS (
    SELECT DISTINCT patent_id, assignee_id AS company_id FROM raw_pc
    WHERE patent_id IN (SELECT patent_id FROM patents)
      AND assignee_id IN (SELECT company_id FROM companies)
)
"""


def _c(body: str) -> str:
    return f"WITH {_CLEAN} {body}"


def _stage(table: str, raw: str) -> str:
    return f"""SELECT '{table}' AS stage, (SELECT count(*) FROM {raw}) AS "before",
                      (SELECT count(*) FROM {table}) AS "after\""""


_DROPS = _c(
    'SELECT stage, "before", "after", "before" - "after" AS dropped, '
    'round(("before" - "after")::DOUBLE / "before" * 100, 1) AS pct FROM ('
    + " UNION ALL ".join([
        _stage("patents", "raw_p"), _stage("inventors", "raw_i"), _stage("companies", "raw_c"),
        _stage("patent_inventors", "raw_pi"), _stage("patent_companies", "raw_pc"),
    ])
    + ")"
)


def _why(table: str, source: str, reasons: dict[str, str]) -> str:
    """Dropped rows by the first reason that holds, and the copies among the rest."""
    whens = " ".join(f"WHEN {holds} THEN '{name}'" for name, holds in reasons.items())
    names = ", ".join(f"('{name}')" for name in [*reasons, "copy"])
    return f"""
        SELECT '{table}' AS stage, reason, coalesce(n, 0) AS "rows"
        FROM (VALUES {names}) AS v(reason) LEFT JOIN (
            SELECT coalesce(why, 'copy') AS reason,
                   count(*) - CASE WHEN why IS NULL THEN (SELECT count(*) FROM {table}) ELSE 0 END AS n
            FROM (SELECT CASE {whens} END AS why FROM {source}) GROUP BY why
        ) USING (reason)"""


_NO_NAME = f"""{_strip(f"concat({_strip('name_first')}, ' ', {_strip("nullif(name_last, 'N/A')")})")} = ''"""
_DAY_OF = f"CASE WHEN {_ISO} THEN try_cast(date AS DATE) END"
_REJECTS = _c(" UNION ALL ".join([
    _why("patents", "raw_p", {
        "no id": "patent_id IS NULL",
        "no title": f"coalesce({_collapse('title')}, '') = ''",
        "bad date": f"({_DAY_OF}) IS NULL",
        "year out of range": f"year({_DAY_OF}) NOT BETWEEN 1976 AND 2030",
    }),
    _why("inventors", "raw_i", {"no name": _NO_NAME}),
    _why("companies", "raw_c", {"no name": f"coalesce({_strip('organization')}, '') = ''"}),
    _why("patent_inventors", """(
        SELECT patent_id, coalesce(disambig_inventor_id, inventor_id) AS e FROM raw_pi)""", {
        "no key": "patent_id IS NULL OR e IS NULL",
        "unknown inventor": "e NOT IN (SELECT inventor_id FROM inventors WHERE inventor_id IS NOT NULL)",
        "unknown patent": "patent_id NOT IN (SELECT patent_id FROM patents WHERE patent_id IS NOT NULL)",
    }),
    _why("patent_companies", "(SELECT patent_id, assignee_id AS e FROM raw_pc)", {
        "no key": "patent_id IS NULL OR e IS NULL",
        "unknown company": "e NOT IN (SELECT company_id FROM companies WHERE company_id IS NOT NULL)",
        "unknown patent": "patent_id NOT IN (SELECT patent_id FROM patents WHERE patent_id IS NOT NULL)",
    }),
]))


def _key_rules(table: str, key: str, required: list[str]) -> list[str]:
    rules = [f"""
        SELECT '{table}' AS "table", 'unique({key})' AS "check", count(*) AS violations
        FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)"""]
    for c in required:
        rules.append(f"""
        SELECT '{table}', 'not_null({c})', count(*) FROM {table} WHERE {c} IS NULL""")
    return rules


def _reference(table: str, column: str, parent: str) -> str:
    return f"""
        SELECT '{table}', 'references({column} -> {parent})', count(*)
        FROM {table} ANTI JOIN {parent} USING ({column})"""


_RULES = " UNION ALL ".join([
    *_key_rules("patents", "patent_id", ["patent_id", "title"]),
    *_key_rules("inventors", "inventor_id", ["inventor_id", "name"]),
    *_key_rules("companies", "company_id", ["company_id", "name"]),
    *_key_rules("patent_inventors", "patent_id, inventor_id", ["patent_id", "inventor_id"]),
    *_key_rules("patent_companies", "patent_id, company_id", ["patent_id", "company_id"]),
    _reference("patent_inventors", "patent_id", "patents"),
    _reference("patent_inventors", "inventor_id", "inventors"),
    _reference("patent_companies", "patent_id", "patents"),
    _reference("patent_companies", "company_id", "companies"),
])

_FLAWED = """WITH
patents AS (
    SELECT o_orderkey AS patent_id, nullif(o_orderpriority, '5-LOW') AS title FROM orders
),
inventors AS (SELECT c_custkey AS inventor_id, c_name AS name FROM customer),
companies AS (SELECT s_suppkey AS company_id, s_name AS name FROM supplier),
patent_inventors AS (SELECT l_orderkey AS patent_id, l_partkey AS inventor_id FROM lineitem),
patent_companies AS (SELECT l_orderkey AS patent_id, l_suppkey AS company_id FROM lineitem)
"""

ORACLE_SQL: dict[str, str] = {
    "q1_top_inventors": _m(_entity_top("ilinks", "inventor_id", "name", "patent_count", 20)),
    "q2_top_companies": _m(_entity_top("clinks", "company_id", "company", "patent_count", 20)),
    "q3_country_share": _m(_country_top("patent_count")),
    "q4_yearly_trend": _m(_yearly("patent_count")),
    "q5_patent_detail": _m("""
        SELECT patent_id, title, filing_date, "year", i.name AS inventor_name,
               i.country AS inventor_country, c.name AS company_name
        FROM patents
        LEFT JOIN patent_inventors USING (patent_id)
        LEFT JOIN patent_companies USING (patent_id)
        LEFT JOIN inventors AS i USING (inventor_id)
        LEFT JOIN companies AS c USING (company_id)
        ORDER BY "year" DESC NULLS LAST, patent_id,
                 inventor_id NULLS FIRST, company_id NULLS FIRST
        LIMIT 500
    """),
    "q6_country_year_activity": _m("""
        SELECT country, "year", count(DISTINCT inventor_id) AS active_inventors,
               count(*) AS total_patents,
               round(count(*)::DOUBLE / count(DISTINCT inventor_id), 2) AS patents_per_inventor
        FROM ilinks JOIN patents USING (patent_id)
        WHERE country <> 'UNKNOWN' AND "year" IS NOT NULL
        GROUP BY ALL ORDER BY "year" DESC, total_patents DESC, country LIMIT 100
    """),
    "q7_ranked_inventors": _m(
        _ranked("global_rank, country_rank, name, country, patent_count, pct_of_total")),
    "r_total_patents": _m("SELECT count(*) AS n FROM patents"),
    "r_top_inventors": _m(_entity_top("ilinks", "inventor_id", "name", "patents", 20)),
    "r_top_companies": _m(_entity_top("clinks", "company_id", "company", "patents", 20)),
    "r_countries": _m(_country_top("patents")),
    "r_yearly": _m(_yearly("patents")),
    "r_ranked_inventors": _m(
        _ranked('global_rank AS "rank", name, country, patent_count, pct_of_total')),
    "r_summary": _SUMMARY,
    "v_top_inventors": _m(
        "SELECT name, patents FROM ("
        + _entity_top("ilinks", "inventor_id", "name", "patents", 10) + ")"),
    "v_top_companies": _m(
        "SELECT company, patents FROM ("
        + _entity_top("clinks", "company_id", "company", "patents", 10) + ")"),
    "v_country_share_other": _share_other("place <= 8"),
    "v_country_share_rest": _share_other("true"),
    "v_top5_countries": _m("SELECT country FROM top5", _TOP5),
    "v_country_trend": _trend_wide('"year" IS NOT NULL'),
    "v_country_trend_long": _trend_long('"year" IS NOT NULL'),
    "d_overview_totals": _m("""
        SELECT (SELECT count(*) FROM patents) AS patents,
               (SELECT count(*) FROM inventors) AS inventors,
               (SELECT count(*) FROM companies) AS companies,
               (SELECT count(DISTINCT country) FROM inventors WHERE country <> 'UNKNOWN')
                   AS countries
    """),
    "d_yearly": _m(_yearly("patents", _RANGE)),
    "d_top_inventors": _numbered("ilinks", "inventor_id", "name", 20),
    "d_top_companies": _numbered("clinks", "company_id", "company", 15),
    "d_countries": _m(f"""
        SELECT CAST(row_number() OVER (ORDER BY patents DESC, country) AS INTEGER) AS "Rank",
               country, patents, round(patents * 100.0::DOUBLE / n_links, 2) AS share_pct
        FROM sizes, (
            SELECT country, count(DISTINCT patent_id) AS patents
            FROM ilinks JOIN patents USING (patent_id)
            WHERE country <> 'UNKNOWN' AND {_RANGE} GROUP BY country)
        QUALIFY "Rank" <= 20
    """),
    "d_yoy_growth": _m(f"""
        SELECT "year", patents,
               (patents::DOUBLE / lag(patents) OVER (ORDER BY "year") - 1) * 100 AS yoy_growth
        FROM ({_yearly("patents", _RANGE)})
    """),
    "d_country_trend": _trend_wide(_RANGE),
    "d_country_trend_long": _trend_long(_RANGE),
    "d_cube_inventors": _cells_of("patent_inventors", "inventor_id"),
    "d_cube_companies": _cells_of("patent_companies", "company_id"),
    "d_cube_countries": _cells_of("ilinks", "country", "country <> 'UNKNOWN'"),
    "c_patents": _c("SELECT * FROM patents"),
    "c_inventors": _c("SELECT * FROM inventors"),
    "c_companies": _c("SELECT * FROM companies"),
    "c_patent_inventors": _c("SELECT * FROM patent_inventors"),
    "c_patent_companies": _c("SELECT * FROM patent_companies"),
    "c_drop_report": _DROPS,
    "c_reject_report": _REJECTS,
    "job_rejects": _REJECTS,
    "c_integrity": _m(_RULES),
    "c_integrity_flawed": _FLAWED + _RULES,
    "c_collapse_spaces": f"SELECT doc_id, {_collapse('text')} AS text FROM documents",
    "s_raw_patents": _c("SELECT patent_id, title, abstract, date FROM raw_p"),
    "s_raw_inventors_gzip": _c("""
        SELECT inventor_id, disambig_inventor_id, name_first, nullif(name_last, 'N/A') AS name_last,
               nullif(country, 'null') AS country
        FROM raw_i
    """),
    "s_raw_companies_bzip2": _c(
        "SELECT assignee_id, organization, nullif(country, 'null') AS country FROM raw_c"),
    "s_clean_csv": _m("""
        SELECT CAST(patent_id AS VARCHAR) AS patent_id, title, CAST(NULL AS VARCHAR) AS abstract,
               filing_date, "year"
        FROM patents
    """),
    "s_sql_on_views": _m(
        "SELECT country, count(*) AS links FROM ilinks WHERE country <> 'UNKNOWN' GROUP BY country"),
    "s_summary_file": _SUMMARY,
    "s_report_file": _m(_entity_top("ilinks", "inventor_id", "name", "patents", 20)),
    "job_drop_report": _DROPS,
}

ORACLE_SQL |= {
    "s_bitmap_countries": _m("""
        SELECT country, count(DISTINCT patent_id) AS patent_count FROM ilinks
        WHERE country <> 'UNKNOWN' GROUP BY country
    """),
    "d_cached_countries": ORACLE_SQL["d_countries"],
    "s_export_file": ORACLE_SQL["d_countries"],
    "s_export_inventors": ORACLE_SQL["d_top_inventors"],
    "s_export_companies": ORACLE_SQL["d_top_companies"],
    "s_snapshot": _m("""
        SELECT CAST(patent_id AS VARCHAR) AS patent_id, title, CAST(NULL AS VARCHAR) AS abstract,
               filing_date, "year"
        FROM patents
    """),
}
