"""The registered queries of the dealt operators, bound to the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.llm import (
    bpe, decontaminate, line_dedup, prefix_trie, quality_rules, resampling, simhash,
    suffix_dedup, token_counts, toxicity, training_order, urls, warc,
)
from linkloom.llm.store import Store


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence as read back from the shards."""
    path = Store(spark).path("training")
    training_order.materialise(
        _table(spark, sf_dir, "documents"), path,
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        key=20240517, length=1024, shard=8192,
    )
    made = training_order.read(spark, path)
    return made.select("slot", "shard", "offset", "sequence", F.sha2("ids", 256).alias("ids_sha256"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    kept = line_dedup.delete_repeated_runs(docs, min_lines=2, min_words=50)
    return kept.select("doc_id", "lines_deleted", F.sha2("text", 256).alias("kept_sha256"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.drop("_key")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Store(spark).path("archives")
    warc.write(_table(spark, sf_dir, "pages"), path)
    found = warc.resolved(warc.read(spark, path))
    return found.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_matches"
    )


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


URL_RULES = [
    urls.Rule("com", "/", allow=True),
    urls.Rule("example.com", "/en/", allow=False),
    urls.Rule("www.example.com", "/en/", allow=True),
    urls.Rule("net", "/es/", allow=False),
    urls.Rule("net", "/fr/", allow=False),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    made = suffix_dedup.without_repeats(docs, length=200).select(
        "h1", "h2", "n_bytes", gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
    return suffix_dedup.for_documents(docs, made)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode(_table(spark, sf_dir, "documents"), vocabulary, keep=["doc_id"])
    return bpe.decode(coded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ["doc_id"]
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = token_counts.lengths(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=[],
    )
    return token_counts.histogram(made)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations that begin with turns of the first of their five."""
    store = Store(spark)
    gathered = prefix_trie.gather(_table(spark, sf_dir, "conversations"), store)
    lent = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    convs = prefix_trie.with_shared_heads(gathered, lent, F.col("conv_id") - F.col("conv_id") % 5, 8)
    return prefix_trie.nodes(convs, store).drop("digest")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
        percent=10, least_words=20, features=resampling.Features(n=1, buckets=10_000), seed=2024,
    )


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4, F.lit(0))
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), Store(spark), usable=fold != 2)
    return toxicity.judge(docs, model, ["doc_id"]).select(
        "doc_id", (fold == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "passages",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_training_order": op1_training_order,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_warc": op4_warc,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_bpe": op8_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_counts": op10_token_counts,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_resample": op12_resample,
    "op13_toxicity": op13_toxicity,
}

# Runs of two lines, or one of 50 words, decide: a line goes if a run that holds it began at an
# earlier place.
_OP2 = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS p
  FROM documents
), pair AS (
  SELECT doc_id, p, line, lead(line) OVER w AS line2, lead(p) OVER w AS p2
  FROM line WHERE regexp_matches(line, '[^ \t\x0b\x0c\r]')
  WINDOW w AS (PARTITION BY doc_id ORDER BY p)
), later AS (
  SELECT doc_id, p, p2 FROM pair WHERE line2 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY line, line2 ORDER BY doc_id, p) > 1
), wide AS (
  SELECT doc_id, p FROM line WHERE len(regexp_extract_all(line, '[^ \t\x0b\x0c\r]+')) >= 50
  QUALIFY row_number() OVER (PARTITION BY line ORDER BY doc_id, p) > 1
), gone AS (
  SELECT doc_id, p FROM later UNION SELECT doc_id, p2 FROM later UNION SELECT doc_id, p FROM wide
), kept AS (
  SELECT doc_id, count(gone.p) AS lines_deleted,
         coalesce(string_agg(line, chr(10) ORDER BY line.p) FILTER (WHERE gone.p IS NULL), '') AS t
  FROM line LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, coalesce(lines_deleted, 0) AS lines_deleted,
       CASE WHEN text IS NOT NULL THEN sha256(coalesce(t, '')) END AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""

_OP4 = """
WITH page AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), first AS (
  SELECT payload_digest, min(page_id) AS least FROM page WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > least THEN least END AS refers_to,
       true AS digest_matches
FROM page LEFT JOIN first USING (payload_digest)
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's bytes in SQL: one step for each bit."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * (i // 8) + 1, 2))::INT"
    step = "xor(crc >> 1, CASE WHEN xor(crc, bit) & 1 = 1 THEN 3988292384 ELSE 0 END)"
    bits = f"[(({byte} >> (i % 8)::INT) & 1)::BIGINT FOR i IN range(8 * strlen({text}))]"
    return (f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda crc, bit: {step}), "
            "4294967295)")


_OP11 = f"""
WITH turn AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (
           PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')
         ) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), named AS (
  SELECT DISTINCT c, c::VARCHAR AS name FROM turn
), conv AS (
  SELECT c, c - c % 5 AS g, {_crc32("name")} % 9 AS h FROM named
), rebuilt AS (
  SELECT conv.c, n, role, text FROM conv JOIN turn ON turn.c = g AND n <= h
  UNION ALL
  SELECT conv.c, n + h, role, text FROM conv JOIN turn ON turn.c = conv.c AND n > h
), placed AS (
  SELECT c, row_number() OVER w AS d, strlen(text) AS bytes,
         md5(string_agg(strlen(role) || ':' || md5(role || text), ',') OVER w) AS k
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY n)
), member AS (
  SELECT c, 0 AS d, 0 AS bytes, 'root' AS k FROM conv UNION ALL SELECT c, d, bytes, k FROM placed
), step AS (
  SELECT *, lag(k) OVER w AS over, lead(k) OVER w IS NULL AS ends
  FROM member WINDOW w AS (PARTITION BY c ORDER BY d)
), node AS (
  SELECT k, over, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * bytes AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends
  FROM step GROUP BY k, over, d, bytes
), children AS (
  SELECT over AS k, count(*) AS n FROM node GROUP BY 1
), subtree AS (
  SELECT DISTINCT top.k AS top, low.k FROM member AS top JOIN member AS low USING (c)
  WHERE low.d >= top.d
), summed AS (
  SELECT top AS k, sum(saved) AS saved, count(*) FILTER (WHERE children.n IS NULL) AS leaves
  FROM subtree JOIN node USING (k) LEFT JOIN children USING (k) GROUP BY 1
)
SELECT node.conv_id, node.d AS depth, parent.conv_id AS parent_conv_id, node.n_convs,
       coalesce(children.n, 0) AS n_children, leaves AS n_leaves,
       summed.saved::BIGINT AS saved_tokens, node.ends AS ends_sha256
FROM node JOIN summed USING (k) LEFT JOIN children USING (k)
LEFT JOIN node AS parent ON parent.k = node.over
"""

_OP12 = f"""
WITH source AS (
  SELECT 's' AS part, row_number() OVER () AS n, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark
), split AS (
  SELECT part, n, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
  FROM source
), kind AS (
  SELECT word, {_crc32("word")} % 10000 AS bucket FROM (SELECT DISTINCT word FROM split)
), met AS (
  SELECT part, n, bucket, count(*) AS c FROM split JOIN kind USING (word) GROUP BY 1, 2, 3
), bucket AS (
  SELECT bucket, sum(c) FILTER (WHERE part = 's') AS s, sum(c) FILTER (WHERE part = 't') AS t
  FROM met GROUP BY 1
), total AS (
  SELECT coalesce(sum(s), 0)::DOUBLE AS s, coalesce(sum(t), 0)::DOUBLE AS t FROM bucket
), gain AS (
  SELECT bucket, floor(1000 * ln(
    ((coalesce(bucket.t, 0) + 1)::DOUBLE * (total.s + 10000))
    / ((coalesce(bucket.s, 0) + 1)::DOUBLE * (total.t + 10000)))) AS gain
  FROM bucket, total
), weighed AS (
  SELECT n, sum(c)::BIGINT AS n_features, floor(sum(c * gain) / sum(c))::BIGINT AS weight
  FROM met JOIN gain USING (bucket) WHERE part = 's' GROUP BY n
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM source LEFT JOIN weighed USING (n) WHERE part = 's'
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features
  ) AS place, floor(10 * count(*) FILTER (WHERE n_features >= 20) OVER () / 100) AS drawn
  FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank
FROM ranked
"""

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": _OP2, "op4_warc": _OP4, "op11_prefix_trie": _OP11, "op12_resample": _OP12,
}
