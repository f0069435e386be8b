"""The model built from a star schema of orders, suppliers and customers.

Orders stand for patents, suppliers for inventors, customers for companies, and order
lines link the first two. ``RAW_SQL`` derives raw files with the flaws that cleaning is for:
padded and blank texts, missing values, several date formats, repeated keys and links to
nothing. It is plain SQL, so that another engine can derive the same rows for comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.functions.text import missing_to_null
from linkloom.schemas import UNKNOWN
from linkloom.sources import files
from linkloom.sources.delimited import ORDINAL
from linkloom.tables import Tables


# The columns used of each star table. Naming them spares reading a footer
# per table before a query can be planned.
STAR: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


# The star tables that the model is made of.
MODEL_SOURCES = ["orders", "lineitem", "supplier", "customer", "nation"]


def model_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The five model tables, as lazy frames over the star schema."""
    read = _reader(spark, sf_dir)
    orders, lines = read("orders"), read("lineitem")
    patents = orders.select(
        F.col("o_orderkey").alias("patent_id"),
        F.col("o_orderpriority").alias("title"),
        F.lit(None).cast("string").alias("abstract"),
        F.to_date("o_orderdate").alias("filing_date"),
        F.year("o_orderdate").alias("year"),
    )
    return Tables(
        patents=patents,
        inventors=_people(read("supplier"), read("nation"), "s", "s_suppkey", "inventor_id"),
        companies=_people(read("customer"), read("nation"), "c", "c_custkey", "company_id"),
        patent_inventors=files.spread(lines.select(
            F.col("l_orderkey").alias("patent_id"), F.col("l_suppkey").alias("inventor_id")
        ).where("patent_id IS NOT NULL AND inventor_id IS NOT NULL"), "patent_id", "inventor_id").distinct(),
        patent_companies=orders.select(
            F.col("o_orderkey").alias("patent_id"), F.col("o_custkey").alias("company_id")
        ).where("patent_id IS NOT NULL AND company_id IS NOT NULL"),
        unique_links=True,
    )


def _people(people: DataFrame, nation: DataFrame, prefix: str, key: str, name: str) -> DataFrame:
    """Entities with their country."""
    country = F.when(F.col("n_nationkey") == 0, UNKNOWN).otherwise(F.col("n_name"))
    joined = people.join(nation, F.col(f"{prefix}_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.col(key).alias(name), F.col(f"{prefix}_name").alias("name"), country.alias("country")
    )


def flawed_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Model tables that break rules: repeated links, links to nothing, missing titles."""
    read = _reader(spark, sf_dir)
    good, lines = model_tables(spark, sf_dir), read("lineitem")
    title = F.when(F.col("title") != "5-LOW", F.col("title"))
    return Tables(
        patents=good.patents.withColumn("title", title),
        inventors=good.companies.withColumnRenamed("company_id", "inventor_id"),
        companies=good.inventors.withColumnRenamed("inventor_id", "company_id"),
        patent_inventors=lines.select(
            F.col("l_orderkey").alias("patent_id"), F.col("l_partkey").alias("inventor_id")
        ),
        patent_companies=lines.select(
            F.col("l_orderkey").alias("patent_id"), F.col("l_suppkey").alias("company_id")
        ),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw files by name, read as :func:`read_raw` would, with ``_ordinal``."""
    read = _reader(spark, sf_dir)
    sources = {n: read(n) for n in ("lineitem", "customer", "supplier", "nation", "region")}
    raw = {}
    for name, sql in RAW_SQL.items():
        used = {n: frame for n, frame in sources.items() if f"{{{n}}}" in sql}
        frame = spark.sql(sql, **used)
        texts = frame.drop(*RAW_ORDER[name])
        place = F.struct(*RAW_ORDER[name]).alias(ORDINAL)
        raw[name] = missing_to_null(frame.select(*texts.columns, place))
    return raw


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reader(spark, sf_dir)("documents")


def _reader(spark: SparkSession, sf_dir: str):
    return lambda name: spark.read.schema(STAR[name]).parquet(f"{sf_dir}/{name}.parquet")


_COUNTRY = """
    CASE n_nationkey WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN ' us\u00a0'
                     WHEN 3 THEN 'NA' WHEN 4 THEN 'null' ELSE lower(r_name) END
"""
_DAY = "cast(cast(l_shipdate AS date) AS string)"

RAW_SQL: dict[str, str] = {
    "g_patent": f"""
        SELECT cast(l_orderkey AS string) AS patent_id,
            CASE WHEN l_quantity < 2 THEN NULL WHEN l_quantity < 4 THEN ' \t\u3000'
                 ELSE concat('\t Part\u00a0\n', cast(l_partkey AS string), '\u3000 "', l_returnflag,
                             '"\x1f', l_linestatus, '\u00a0') END AS title,
            CASE WHEN l_tax < 0.01 THEN NULL WHEN l_tax < 0.02 THEN ' \t'
                 ELSE concat('  supplied\n\nby ', cast(l_suppkey AS string)) END AS abstract,
            CASE WHEN l_discount < 0.01 THEN NULL
                 WHEN l_discount < 0.02 THEN concat('1975', substr({_DAY}, 5))
                 WHEN l_returnflag = 'A' THEN {_DAY}
                 WHEN l_returnflag = 'N' THEN replace({_DAY}, '-0', '-')
                 WHEN l_linestatus = 'O' THEN replace({_DAY}, '-', '/')
                 ELSE concat(substr({_DAY}, 1, 5), '02-', substr({_DAY}, 9)) END AS date,
            l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice,
            l_discount, l_tax, l_returnflag, l_linestatus
        FROM {{lineitem}}
    """,
    "g_inventor_disambiguated": f"""
        SELECT concat('c', cast(c_custkey AS string)) AS inventor_id,
            CASE WHEN c_mktsegment <> 'BUILDING'
                 THEN concat('d', cast(cast(floor(c_custkey / 3) AS bigint) AS string))
                 END AS disambig_inventor_id,
            CASE WHEN c_acctbal >= 0 THEN concat(' ', lower(c_mktsegment), '\u00a0') END AS name_first,
            CASE WHEN c_acctbal < 500 THEN 'N/A' ELSE concat(c_name, '\t') END AS name_last,
            {_COUNTRY} AS country,
            c_custkey
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
            JOIN {{region}} ON n_regionkey = r_regionkey
    """,
    "g_assignee_disambiguated": f"""
        SELECT concat('s', cast(cast(floor(s_suppkey / 2) AS bigint) AS string)) AS assignee_id,
            CASE WHEN s_acctbal < 0 THEN '\u3000' ELSE concat('\t', s_name, ' Ltd\u00a0') END AS organization,
            {_COUNTRY} AS country,
            s_suppkey
        FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
            JOIN {{region}} ON n_regionkey = r_regionkey
    """,
    "g_patent_inventor": """
        SELECT cast(l_orderkey AS string) AS patent_id,
            CASE WHEN l_linestatus = 'O' THEN concat('c', cast(l_partkey AS string)) END AS inventor_id,
            CASE WHEN l_returnflag <> 'R'
                 THEN concat('d', cast(cast(floor(l_partkey / 3) AS bigint) AS string))
                 END AS disambig_inventor_id,
            cast(l_linenumber AS string) AS sequence,
            l_linenumber
        FROM {lineitem}
    """,
    "g_patent_assignee": """
        SELECT cast(l_orderkey AS string) AS patent_id,
            CASE WHEN l_quantity > 3
                 THEN concat('s', cast(cast(floor(l_suppkey / 2) AS bigint) AS string))
                 END AS assignee_id,
            cast(l_linenumber AS string) AS sequence,
            l_linenumber
        FROM {lineitem}
    """,
}

# The columns that give the place of a row in its raw file.
RAW_ORDER: dict[str, list[str]] = {
    "g_patent": [
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    ],
    "g_inventor_disambiguated": ["c_custkey"],
    "g_assignee_disambiguated": ["s_suppkey"],
    "g_patent_inventor": ["l_linenumber"],
    "g_patent_assignee": ["l_linenumber"],
}
