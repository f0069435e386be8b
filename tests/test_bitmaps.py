"""Distinct patents per country from bitmaps, over several runs."""

import pytest
from pyspark.sql import functions as F
from samples import empty, skewed

from linkloom.operators import bitmaps, counting


def counts(spark, store):
    return {r.country: r.patent_count for r in bitmaps.country_counts(spark, store).collect()}


def expected(links, inventors):
    rows = counting.patents_per_country(links, inventors).collect()
    return {r.country: r.patent_count for r in rows}


def test_runs_add_up_to_the_whole(spark, tmp_path):
    """Parts that share patents, links and countries; the last run has nothing new."""
    t, store = skewed(spark, 5, orphans=True, unique=False), str(tmp_path)
    links = t.patent_inventors.withColumn("_part", F.pmod(F.xxhash64("patent_id", "inventor_id"), F.lit(3)))
    seen = links.limit(0)
    for part in (F.col("_part") == 0, F.col("_part") >= 1, F.col("_part") == 2):
        bitmaps.add(store, links.where(part).drop("_part"), t.inventors)
        seen = seen.union(links.where(part))
        assert counts(spark, store) == expected(seen.drop("_part"), t.inventors)
    assert counts(spark, store) == expected(t.patent_inventors, t.inventors)


def test_nothing_and_nulls(spark, tmp_path):
    t = empty(spark)
    assert counts(spark, f"{tmp_path}/none") == {}
    bitmaps.add(f"{tmp_path}/a", t.patent_inventors, t.inventors)
    assert counts(spark, f"{tmp_path}/a") == {}
    links = spark.createDataFrame([("p", "i"), (None, "i"), ("q", None)], "patent_id string, inventor_id string")
    people = spark.createDataFrame([("i", "n", "US")], "inventor_id string, name string, country string")
    bitmaps.add(f"{tmp_path}/a", links, people)
    assert counts(spark, f"{tmp_path}/a") == {"US": 1}


def test_a_run_that_dies_leaves_the_counts(spark, tmp_path, monkeypatch):
    t, store = skewed(spark, 6), str(tmp_path)
    bitmaps.add(store, t.patent_inventors.limit(200), t.inventors)
    before = counts(spark, store)
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(bitmaps.Snapshots, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
        bitmaps.add(store, t.patent_inventors, t.inventors)
    assert counts(spark, store) == before
    bitmaps.add(store, t.patent_inventors, t.inventors)
    assert counts(spark, store) == expected(t.patent_inventors, t.inventors)


def test_a_country_is_many_buckets(spark, tmp_path):
    """A hundred thousand patents of one country are spread over buckets and counted exactly."""
    n = 100_000
    links = spark.range(n).select(F.concat(F.lit("p"), "id").alias("patent_id"), F.lit("i").alias("inventor_id"))
    people = spark.createDataFrame([("i", "n", "US")], "inventor_id string, name string, country string")
    bitmaps.add(str(tmp_path), links.union(links), people)
    (folder,) = (tmp_path / "versions").iterdir()
    rows = spark.read.parquet(f"{folder}/bitmaps")
    assert rows.count() >= n // 32_768 and counts(spark, str(tmp_path)) == {"US": n}
