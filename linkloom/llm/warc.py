"""WARC archives: written as text rows, read back by verifying chains of record borders.

The reader splits files at every occurrence of the version line, so large archives are read by
many tasks. Each occurrence is a candidate: if a header follows, its length and Content-Length
say where the next record must begin. Pointer jumping from offset 0 of every file, in as many
rounds as the logarithm of its records, marks what the chain reaches. Version lines inside
payloads are not reached; they are put back into the record that holds them. A chain that does
not end at the end of its file is an error, so truncated archives do not lose records silently.

* A null payload is empty, a null target is left out. Rows with a null id are responses, as nothing
  could refer to them, and so are, of ties, all rows repeated under the smallest id of their payload.
* A long payload is one row of text, so at most 2 GB. Empty tables make archives without records.
* Other columns are not written, so their names may be any.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from linkloom.llm.store import Store, ship

MAGIC = "WARC/1.1\r\n"
_BREAK = "\r\n\r\n"
_URN = "urn:page:"
MIN_REVISIT_BYTES = 100


def _line(name: str, value: Column) -> Column:
    """A header line, left out if the value is null. Line breaks in values become blanks."""
    return F.concat(F.lit(f"{name}: "), F.translate(value, "\r\n", "  "), F.lit("\r\n"))


def typed(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """``pages`` with ``_payload`` bytes, ``_digest``, ``_type`` and ``_refers_to``."""
    rows = pages.withColumn(
        "_payload", F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    ).withColumn("_digest", F.sha2("_payload", 256))
    long = F.octet_length("_payload") >= MIN_REVISIT_BYTES
    first = (
        rows.where(long & F.col(f"`{key}`").isNotNull()).groupBy("_digest")
        .agg(F.min(f"`{key}`").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    )
    # Written, so that its size is known and pages need not be shuffled for a small one.
    first = Store(pages.sparkSession).put("first", first.drop("_n"))
    rows = rows.join(first, "_digest", "left")
    other = F.when(long & (F.col(f"`{key}`") > F.col("_first")), F.col("_first"))
    return rows.withColumn("_refers_to", other).drop("_first").withColumn(
        "_type", F.when(F.col("_refers_to").isNull(), "response").otherwise("revisit")
    )


def write(
    pages: DataFrame, path: str, key: str = "page_id", target: str = "url",
    payload: str = "html", date: str = "2024-01-01T00:00:00Z",
) -> None:
    """One record per page; a payload seen under a smaller id is written as a revisit of it."""
    rows = typed(pages, key, payload)
    response = F.col("_type") == "response"

    def urn(c: Column) -> Column:
        return F.concat(F.lit(f"<{_URN}"), c.cast("string"), F.lit(">"))

    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    size = F.when(response, F.octet_length("_payload")).otherwise(0)
    head = F.concat(
        F.lit(MAGIC),
        F.concat_ws(
            "",
            _line("WARC-Type", F.col("_type")),
            _line("WARC-Record-ID", urn(F.col(f"`{key}`"))),
            _line("WARC-Date", F.lit(date)),
            _line("WARC-Target-URI", F.col(f"`{target}`")),
            _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("_digest"))),
            _line("WARC-Refers-To", urn(F.col("_refers_to"))),
            _line("WARC-Profile", F.when(~response, profile)),
            _line("Content-Type", F.lit("text/html")),
            _line("Content-Length", size.cast("string")),
        ),
        F.lit("\r\n"),
    )
    block = F.when(response, F.col("_payload")).otherwise(F.lit(b""))
    record = F.concat(head.cast("binary"), block).cast("string").alias("value")
    # Each row ends with the blank lines that end a record.
    rows.select(record).write.mode("overwrite").option("lineSep", _BREAK).text(path)


def _header(body: bytes) -> tuple[dict[str, str], int, int] | None:
    """Fields, length of the header, and Content-Length, if ``body`` begins with a header."""
    end = body.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in body[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    return (fields, end + 4, int(length)) if length.isascii() and length.isdigit() else None


_SEGMENT = (
    "file string, block long, file_size long, seq long, start long, size long, body binary, "
    "fields map<string,string>, head long, length long"
)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """What lies between version lines; ``start`` counts from where its split began to read."""
    raw = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("value").cast("binary").alias("body"),
    )
    ship(spark)
    segment = StructType.fromDDL(_SEGMENT)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(segment)
        place, seq, start = None, 0, 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if (row["file"], row["block"]) != place:
                    place, seq, start = (row["file"], row["block"]), 0, 0
                size = len(row["body"])
                head = _header(row["body"])
                rows.append(row | {
                    "seq": seq, "start": start, "size": size,
                    "fields": list(head[0].items()) if head else None,
                    "head": head and head[1], "length": head and head[2],
                })
                seq, start = seq + 1, start + size + len(MAGIC)
            yield pa.RecordBatch.from_pylist(rows, schema)

    return raw.mapInArrow(cut, segment)


def reachable(candidates: DataFrame, store: Store) -> DataFrame:
    """``file``, ``offset`` of the candidates that chains from offset 0 reach.

    ``candidates`` has ``file``, ``offset`` and ``next``, null if no header follows.
    """
    known = candidates.select("file", F.col("offset").alias("next"), F.lit(True).alias("_there"))
    now = store.put("jump_0", candidates.join(known, ["file", "next"], "left").select(
        "file", "offset", F.when(F.col("_there"), F.col("next")).alias("jump"),
        (F.col("offset") == 0).alias("reached"),
    ))
    step = 0
    while True:
        marks = now.where("reached AND jump IS NOT NULL") \
            .select("file", F.col("jump").alias("offset")).distinct().withColumn("_mark", F.lit(True))
        ahead = now.select("file", F.col("offset").alias("jump"), F.col("jump").alias("far"))
        step += 1
        after = store.put(f"jump_{step}", now.join(ahead, ["file", "jump"], "left")
            .join(marks, ["file", "offset"], "left").select(
                "file", "offset", F.col("far").alias("jump"),
                (F.col("reached") | F.coalesce("_mark", F.lit(False))).alias("reached"),
            ))
        if after.where("reached").count() == now.where("reached").count():
            return after.where("reached").select("file", "offset")
        now = after


def read(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``offset``, ``fields`` and ``payload`` of every record of the archives."""
    store = Store(spark)
    segments = _segments(spark, path)
    light = store.put("light", segments.select(
        "file", "block", "file_size", "seq", "start", "size", "head", "length"
    ))
    blocks = light.groupBy("file", "block").agg(
        F.sum(F.col("size") + len(MAGIC)).alias("bytes")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "file", "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base")
    )
    # A segment follows its version line; the first of a file follows none.
    offset = F.col("base") + F.col("start") - len(MAGIC)
    placed = store.put("placed", light.join(blocks, ["file", "block"]).withColumn("offset", offset))
    following = F.col("offset") + len(MAGIC) + F.col("head") + F.col("length") + len(_BREAK)
    candidates = placed.where("offset >= 0").select("file", "offset", following.alias("next"))
    chain = store.put("chain", reachable(candidates, store).withColumn("owner", F.col("offset")))

    ends = candidates.join(chain, ["file", "offset"]).groupBy("file").agg(F.max("next").alias("end"))
    sizes = placed.groupBy("file").agg(F.max("file_size").alias("file_size"))
    broken = sizes.join(ends, "file", "left").where("end IS NULL OR end <> file_size").limit(5)
    if names := [row["file"] for row in broken.collect()]:
        raise ValueError(f"records do not end where these archives end: {names}")

    # The record a segment belongs to: its own, or else the last one reached before it.
    within = Window.partitionBy("file", "block").orderBy("offset")
    owned = placed.where("offset >= 0").join(chain, ["file", "offset"], "left")
    last = owned.groupBy("file", "block").agg(F.max("owner").alias("last"))
    carried = last.select("file", "block", F.max("last").over(earlier).alias("carried"))
    owned = owned.join(carried, ["file", "block"]).select(
        "file", "block", "seq", "offset",
        F.coalesce(F.last("owner", ignorenulls=True).over(within), "carried").alias("owner"),
    )
    owned = store.put("owned", owned)
    # Records in several pieces, because they hold version lines, are put together; most are one.
    several = owned.where("offset <> owner").select("file", "owner").distinct()
    pieces = store.put("pieces", owned.join(several, ["file", "owner"]))
    place = ["file", "block", "seq"]
    payload = F.substring("body", (F.col("head") + 1).cast("int"), F.col("length").cast("int"))
    # A row for each block of a file. Written, so that its size decides how it is joined.
    starts = store.put("starts", blocks.select("file", "block", "base"))
    single = (
        segments.join(starts, ["file", "block"])
        .withColumn("offset", offset).where("offset >= 0")
        .join(pieces.select(*place), place, "left_anti")
        .select("file", "offset", "fields", payload.alias("payload"))
    )
    own = F.col("offset") == F.col("owner")
    whole = segments.join(pieces, place).groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("offset", "body"))).alias("p"),
        *[F.first(F.when(own, F.col(c)), ignorenulls=True).alias(c) for c in ("fields", "head", "length")],
    ).select("file", F.col("owner").alias("offset"), "fields", "head", "length", F.aggregate(
        F.slice("p", 2, F.size("p")), F.get("p", F.lit(0))["body"],
        lambda made, x: F.concat(made, F.lit(MAGIC.encode()), x["body"]),
    ).alias("body"))
    return single.unionByName(whole.select("file", "offset", "fields", payload.alias("payload")))


def _id(field: str) -> Column:
    return F.regexp_extract(F.col("fields")[field], rf"^<{_URN}(.*)>$", 1).try_cast("long")


def resolved(records: DataFrame) -> DataFrame:
    """``page_id``, size and digest of the payload, type, what it refers to, target, and whether
    the digest is the one the header states. Revisits have the payload of their response."""
    own = records.select(
        _id("warc-record-id").alias("page_id"), F.col("fields")["warc-type"].alias("record_type"),
        _id("warc-refers-to").alias("refers_to"), F.col("fields")["warc-target-uri"].alias("url"),
        F.col("fields")["warc-payload-digest"].alias("stated"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
    )
    own = Store(records.sparkSession).put("own", own)
    responses = own.where("record_type = 'response'")
    target = responses.groupBy(F.col("page_id").alias("refers_to"), F.col("stated")).agg(
        F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest")
    )
    revisits = own.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    return responses.unionByName(
        revisits.join(target, ["refers_to", "stated"], "left").select(responses.columns)
    ).withColumn("digest_matches", F.col("stated") == F.concat(F.lit("sha256:"), "payload_digest"))
