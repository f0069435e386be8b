import re
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from linkloom.functions import text


def apply(spark, fn, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    out = rows.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()
    return [r.v for r in out]


def test_collapse_spaces_is_unicode_aware(spark):
    values = [" \ta\u00a0 b\n c\u3000 ", "", "\u3000\x1f", None, "a\x85\x0bb", "no change"]
    assert apply(spark, text.collapse_spaces, values) == [
        "a b c", "", "", None, "a b", "no change",
    ]


def test_strip_keeps_inner_spaces(spark):
    assert apply(spark, text.strip, [" \u00a0a  b\t\x1c", "a\nb\n"]) == ["a  b", "a\nb"]


_chars = st.text(
    st.sampled_from(
        " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2003\u2028\u2029\u202f\u205f\u3000"
        "\u200b\ufeffa\u00e9\u00df.*$"
    ),
    max_size=12,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_chars, min_size=50, max_size=200))
def test_spaces_as_in_python(spark, values):
    assert apply(spark, text.strip, values) == [v.strip() for v in values]
    assert apply(spark, text.collapse_spaces, values) == [
        re.sub(r"\s+", " ", v.strip()) for v in values
    ]


def test_null_tokens(spark):
    values = ["Null", "NA", "None", "null", "", "N/A", "nan", " NA"]
    assert apply(spark, text.tokens_to_null, values) == [
        "Null", None, None, None, None, None, None, " NA",
    ]


def test_missing_to_null_spares_namibia(spark):
    rows = spark.createDataFrame([("NA", "NA", 1), ("null", "x", 2)], "country string, b string, n int")
    assert [tuple(r) for r in text.missing_to_null(rows).collect()] == [
        ("NA", None, 1), (None, "x", 2),
    ]


@pytest.mark.parametrize("literal, missing, namibia", [(False, "UNKNOWN", "NA"), (True, "UN", "UN")])
def test_country_code(spark, literal, missing, namibia):
    values = [None, "", "  ", "usa", " us ", "NA", "\u00a0de", "UNKNOWN"]
    got = apply(spark, lambda c: text.country_code(c, literal), values)
    blank = missing if literal else "UNKNOWN"
    assert got == [missing, blank, "UNKNOWN", "US", "US", namibia, "DE", missing]


def test_lenient_date(spark):
    values = [
        "2020-01-05", "2020-1-5", "2020-02-30", "20200109", "2020-01-08 10:00", None, "",
        "2020/01/06", "2020", "2020-1", " 2020-01-05", "2020-01-05\n", "2020-13-01", "0000-01-01",
    ]
    assert apply(spark, text.lenient_date, values[:6]) == [
        date(2020, 1, 5), date(2020, 1, 5), None, None, None, None,
    ]
    assert apply(spark, lambda c: text.lenient_date(c).isNotNull(), values[6:13]) == [False] * 7


def test_percent_is_a_double(spark):
    row = spark.sql("SELECT 1L AS a, 3L AS b").select(text.percent(F.col("a"), F.col("b"), 2).alias("p"))
    assert row.dtypes == [("p", "double")]
    assert row.collect()[0].p == 33.33
