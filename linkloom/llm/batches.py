"""Arrow batches of texts, as groups of bounded size inside a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from linkloom.llm.store import ship

GROUP_BYTES = 1 << 18


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def parts(batch: pa.RecordBatch, sizes: pa.Array, limit: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``limit`` bytes together, by the size of each; a larger row is a
    part of its own. Nothing becomes a Python object before it is part of a small batch."""
    if not batch.num_rows:
        return
    ends = np.cumsum(sizes.fill_null(0).to_numpy().astype(np.int64))
    first = 0
    while first < batch.num_rows:
        room = limit + (int(ends[first - 1]) if first else 0)
        after = max(first + 1, int(np.searchsorted(ends, room, "right")))
        yield batch.slice(first, after - first)
        first = after


def map_texts(
    docs: DataFrame,
    text: str,
    keep: list[str],
    schema: str,
    digest: Callable[[list[bytes]], dict[str, list]],
) -> DataFrame:
    """``keep`` columns and what ``digest`` makes of each text, one row per document.

    ``digest`` gets a group of texts and returns one list of values per column of ``schema``.
    The names of ``keep`` and ``schema`` must differ.
    """
    ship(docs.sparkSession)
    # Kept columns travel as one, so that their names may be any.
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("_row")
    picked = docs.select(row, F.col(f"`{text}`").alias("_text"))
    added = StructType.fromDDL(schema)
    names = [f.name for f in added.fields]
    types = {f.name: to_arrow_type(f.dataType) for f in added.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, pc.binary_length(batch.column("_text"))):
                made = digest(utf8(part.column("_text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), *[pa.array(made[n], type=types[n]) for n in names]],
                    names=["_row", *names],
                )

    made = picked.mapInArrow(run, StructType([picked.schema["_row"], *added.fields]))
    return made.select(*[F.col("_row")[c].alias(c) for c in keep], *names)
