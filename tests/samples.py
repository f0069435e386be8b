"""Small model tables whose results can be worked out by hand."""

from __future__ import annotations

import random
from datetime import date

from linkloom.schemas import MODEL
from linkloom.tables import Tables


def build(spark, patents, inventors, companies, inventor_links, company_links, unique=True):
    frames = [patents, inventors, companies, inventor_links, company_links]
    return Tables(
        *[spark.createDataFrame(rows, schema) for rows, schema in zip(frames, MODEL.values())],
        unique_links=unique,
    )


def patent(pid: str, year: int | None):
    return (pid, f"title {pid}", None, date(year, 6, 1) if year else None, year)


def ties(spark, unique=True) -> Tables:
    """Three inventors tie at the top and three after them; two share a name.

    Patents: p1 p2 of 2018, p3 of 2020, p4 without inventors, p5 without year.
    """
    patents = [patent("p1", 2018), patent("p2", 2018), patent("p3", 2020), patent("p4", 2020),
               patent("p5", None)]
    inventors = [
        ("i1", "Ann", "US"), ("i2", "Ann", "US"), ("i3", "Bo", "DE"), ("i4", "Cy", "DE"),
        ("i5", "Di", "US"), ("i6", "Ed", "UNKNOWN"), ("i7", "Flo", "FR"), ("i8", "Gus", None),
    ]
    companies = [("c1", "Acme", "US"), ("c2", "Bolt", "DE")]
    inventor_links = [
        ("p1", "i1"), ("p2", "i1"), ("p3", "i1"), ("p1", "i2"), ("p2", "i2"), ("p3", "i2"),
        ("p1", "i3"), ("p2", "i3"), ("p5", "i3"), ("p1", "i4"), ("p1", "i5"), ("p1", "i6"),
        ("p2", "i8"),
    ]
    company_links = [("p1", "c1"), ("p1", "c2"), ("p2", "c1"), ("p4", "c2")]
    return build(spark, patents, inventors, companies, inventor_links, company_links, unique)


def skewed(spark, seed: int, orphans: bool = False, unique: bool = True) -> Tables:
    """Random tables in which one inventor holds about a third of all links."""
    rng = random.Random(seed)
    patents = [patent(f"p{i:04}", rng.choice([None, *range(2010, 2020)])) for i in range(400)]
    lands = ["US", "DE", "FR", "JP", "UNKNOWN", None, "GB", "KR", "CN", "CA", "IN", "BR"]
    inventors = [(f"i{i:03}", f"n{i % 40}", rng.choice(lands)) for i in range(120)]
    companies = [(f"c{i:02}", f"f{i}", rng.choice(lands)) for i in range(20)]
    last = 150 if orphans else 119
    pairs = {(p[0], "i000") for p in patents}
    pairs |= {(rng.choice(patents)[0], f"i{rng.randint(1, last):03}") for _ in range(800)}
    firms = {(rng.choice(patents)[0], f"c{int(rng.triangular(0, 19, 0)):02}") for _ in range(300)}
    links = sorted(pairs)
    if not unique:
        links += rng.choices(links, k=200)
    return build(spark, patents, inventors, companies, links, sorted(firms), unique)


def empty(spark) -> Tables:
    return build(spark, [], [], [], [], [])
