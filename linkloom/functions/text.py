"""Column expressions for text, ids, countries and dates. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from linkloom.schemas import NULL_TOKENS, UNKNOWN

# Java's Unicode \s leaves out four separators that Python's str.strip also removes.
_SPACE = r"[\s\x1C-\x1F]+"


def strip(c: Column) -> Column:
    """Drop Unicode white space at both ends."""
    return F.regexp_replace(c, rf"(?U)^{_SPACE}|{_SPACE}$", "")


def collapse_spaces(c: Column) -> Column:
    """Turn every run of Unicode white space into one blank and drop it at both ends."""
    return F.btrim(F.regexp_replace(c, rf"(?U){_SPACE}", " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def tokens_to_null(c: Column, data: Iterable[str] = ()) -> Column:
    """Null for the texts that stand for a missing value, but for those in ``data``."""
    return F.when(~c.isin([t for t in NULL_TOKENS if t not in data]), c)


def missing_to_null(df: DataFrame) -> DataFrame:
    """Apply :func:`tokens_to_null` to every string column; ``NA`` is a country."""
    texts = [n for n, kind in df.dtypes if kind == "string"]
    return df.withColumns({
        n: tokens_to_null(F.col(n), data=["NA"] if n == "country" else []) for n in texts
    })


def country_code(c: Column, literal_nulls: bool = False) -> Column:
    """Two upper-case letters, or ``UNKNOWN`` where nothing is given.

    With ``literal_nulls`` missing countries, the text ``NA`` included, are labelled before
    the cut and so become ``UN``, for results equal to those of older runs.
    """
    if literal_nulls:
        c = F.coalesce(tokens_to_null(c), F.lit(UNKNOWN))
    code = F.upper(strip(c))
    short = F.substring(code, 1, 2)
    # Cleaned countries may be cleaned again: the label is not cut to a code.
    code = short if literal_nulls else F.when(code == UNKNOWN, code).otherwise(short)
    return F.coalesce(blank_to_null(code), F.lit(UNKNOWN))


def lenient_date(c: Column) -> Column:
    """ISO dates, leading zeros optional; anything else is null.

    Extracting first names the column once and spares the cost of failed parses.
    """
    return F.regexp_extract(c, r"\A\d{4}-\d{1,2}-\d{1,2}\z", 0).try_cast("date")


def first_present(df: DataFrame, *names: str) -> Column:
    """The first non-null of those columns the frame has."""
    present = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*present)


def text_or_empty(df: DataFrame, name: str) -> Column:
    """A stripped column; empty for nulls and where the frame lacks the column."""
    return strip(F.coalesce(F.col(name), F.lit(""))) if name in df.columns else F.lit("")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` of ``whole`` in percent, as a rounded double; null if ``whole`` is 0."""
    return F.round(F.try_divide(part.cast("double") * 100, whole), digits)
