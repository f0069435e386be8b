"""URL filter: rules for hosts and paths, and boosted trees for what no rule fits.

The labelled URLs are those that a rule judges. The trees see lexical features: length, depth,
shares of digits, entropy, parameters, and how frequent the host's suffix is and how often blocked.

* A null URL, or one without ``://``, has an empty host and path; only a rule for neither could fit
  it, so the trees judge it. Repeated URLs are judged alike.
* Of rules that fit, the one longest in host and path together wins; of ties that of the longer host.
* Without labelled URLs of both kinds the rest is allowed. Empty tables give no rows.
* Long URLs are read whole. Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructType

from linkloom.llm.store import Store, ship

# At most so many labelled URLs, chosen by a hash, train the trees.
MAX_LABELLED = 20_000


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path begins with ``path``."""

    host: str
    path: str
    allow: bool

    def fits(self) -> Column:
        host = F.col("host")
        below = (host == self.host) | host.endswith(f".{self.host}")
        return below & F.col("path").startswith(self.path)


def with_host_and_path(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``host`` (A-Z in lower case) and ``path``; columns of that name go."""

    def part(n: int) -> Column:
        return F.coalesce(F.regexp_extract(F.col(f"`{url}`"), r"(?s)^.*?://([^/?#]*)([^?#]*)", n), F.lit(""))

    lower = F.translate(part(1), string.ascii_uppercase, string.ascii_lowercase)
    return urls.withColumns({"host": lower, "path": part(2)})


def with_rule(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rule``, the longest that fits, and ``rule_allows``; both null if none fits."""
    name, allows = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), len(r.host))):
        name = F.when(rule.fits(), F.lit(rule.host + rule.path)).otherwise(name)
        allows = F.when(rule.fits(), F.lit(rule.allow)).otherwise(allows)
    return urls.withColumns({"rule": name, "rule_allows": allows})


def lexical(url: str, host: str, path: str) -> list[float]:
    """The features of :data:`FEATURES`."""
    n = max(1, len(url))
    counts = Counter(url).values()
    query = url.partition("#")[0].partition("?")[2]
    labels = host.split(".")
    return [
        float(len(url)), float(len(host)), float(len(path)),
        float(path.strip("/").count("/") + 1 if path.strip("/") else 0),
        sum(c.isdigit() for c in url) / n,
        -sum(c / n * math.log2(c / n) for c in counts),
        float(query.count("&") + 1 if query else 0),
        float(len(labels)), float(max(map(len, labels))), float(url.count("-") + url.count("_")),
    ]


FEATURES = [
    "length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters",
    "labels", "longest_label", "hyphens",
]
_SUFFIX = ["suffix_count", "suffix_blocked"]


def with_features(urls: DataFrame) -> DataFrame:
    """``urls`` (with ``url``, ``host`` and ``path``) and the features."""
    ship(urls.sparkSession)
    names, n = urls.columns, len(urls.columns)
    schema = StructType(list(urls.schema.fields))
    for name in FEATURES:
        schema = schema.add(name, DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [batch.column(c).to_pylist() for c in ("url", "host", "path")]
            made = [lexical(u or "", h, p) for u, h, p in zip(*texts, strict=True)]
            columns = list(zip(*made, strict=True)) or [[] for _ in FEATURES]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], *[pa.array(c, pa.float64()) for c in columns]],
                [*names, *FEATURES],
            )

    return urls.mapInArrow(run, schema)


def _labelled(
    featured: DataFrame, inputs: list[str], w_good: float, w_bad: float, max_labelled: int
) -> DataFrame:
    """At most ``max_labelled`` different URLs that a rule judges; copies add to the weight."""
    return (
        featured.where("rule_allows IS NOT NULL")
        .select(*inputs, (~F.col("rule_allows")).cast("double").alias("label"),
                F.when(F.col("rule_allows"), w_good).otherwise(w_bad).alias("weight"),
                F.xxhash64("url").alias("h"))
        .groupBy(*inputs, "label", "weight", "h").agg(F.count("*").alias("n"))
        .withColumn("weight", F.col("weight") * F.col("n")).drop("n")
        .orderBy("h", "label", *inputs).limit(max_labelled)
    )


def judge(
    urls: DataFrame, rules: list[Rule], url: str = "url", max_labelled: int = MAX_LABELLED,
    trees: int = 20, depth: int = 4,
) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict``: allow or block."""
    store = Store(urls.sparkSession)
    # All columns travel as one, so that their names clash with nothing.
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in urls.columns])
    boxed = urls.select(row.alias("row"), F.col(f"`{url}`").alias("url"))
    ruled = with_rule(with_host_and_path(boxed), rules)
    verdict = F.when(F.col("rule_allows"), "allow").when(~F.col("rule_allows"), "block")
    names = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]

    def result(judged: DataFrame, learned: Column) -> DataFrame:
        return judged.select(
            *[F.col("row")[c].alias(c) for c in names], "host", "path", "rule",
            F.coalesce(verdict, learned).alias("verdict"),
        )

    # How frequent a suffix is among all URLs, and how often the labelled ones are blocked.
    suffix = F.substring_index("host", ".", -1)
    by_suffix = ruled.groupBy(suffix.alias("suffix")).agg(
        F.count("*").alias("all"), F.count("rule").alias("n"),
        F.count_if(~F.col("rule_allows")).alias("bad"),
    )
    total = by_suffix.agg(F.sum("n"), F.sum("bad")).first()
    n, bad = total[0] or 0, total[1] or 0
    if not 0 < bad < n:
        return result(ruled, F.lit("allow"))

    # Both kinds weigh the same, so that the choice of rules does not set the odds of the rest.
    # Rates lean towards a half, so that rare suffixes say little.
    w_bad, w_good = n / (2 * bad), n / (2 * (n - bad))
    blocked, allowed = w_bad * F.col("bad"), w_good * (F.col("n") - F.col("bad"))
    rate = (blocked + 50.0) / (blocked + allowed + 100.0)
    featured = with_features(ruled).withColumn("suffix", suffix).join(by_suffix, "suffix")
    featured = store.put("features", featured.withColumns({
        "suffix_count": F.log1p("all"), "suffix_blocked": rate,
    }).drop("suffix", "all", "n", "bad"))
    inputs = FEATURES + _SUFFIX
    vectors = VectorAssembler(inputCols=inputs, outputCol="vector")
    labelled = _labelled(featured, inputs, w_good, w_bad, max_labelled)
    # A bounded sample; few partitions spare many small tasks in each of the rounds.
    training = store.put("labelled", labelled.coalesce(1)).coalesce(2).persist()
    boosted = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2,
        seed=7, checkpointInterval=-1, predictionCol="blocked", weightCol="weight",
    )
    model = boosted.fit(vectors.transform(training))
    training.unpersist()
    learned = F.when(F.col("blocked") > 0.5, "block").otherwise("allow")
    return result(model.transform(vectors.transform(featured)), learned)
