"""Global positions in a sorted table, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructType

from linkloom.llm.store import Store, ship


def _changes(batch: pa.RecordBatch, keys: list[str], before: list | None) -> np.ndarray:
    """Where a row differs from the row before it in any of the keys."""
    out = np.zeros(batch.num_rows, bool)
    for i, key in enumerate(keys):
        column = batch.column(key)
        out[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        out[0] |= before is None or column[0].as_py() != before[i]
    return out


def with_run_starts(
    frame: DataFrame, order: list[str], runs: dict[str, list[str]], store: Store, name: str
) -> DataFrame:
    """``frame`` with ``at``, the place of a row in ``order`` from 0, and for each of ``runs``
    the place of the first row that has the same values in its columns, which begin ``order``.

    Rows are range-partitioned by the whole order, so that one long run may lie in many
    partitions. Each task numbers its own rows; what runs over a border is settled by one
    summary row per partition, which is all that the driver gets. ``shared`` is false only for
    rows that are alone in the last of the runs; it may be true for a lone row at a border.
    Columns of ``order`` must not be null.
    """
    ship(frame.sparkSession)
    sorted_rows = (
        frame.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id().cast("long"))
    )
    local = {run: f"_{run}" for run in runs}
    schema = StructType(list(sorted_rows.schema.fields))
    for column in ["_row", *local.values()]:
        schema = schema.add(column, LongType())
    schema = schema.add("shared", "boolean")
    names = schema.names

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, last, starts = 0, None, dict.fromkeys(runs, -1)
        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.arange(done, done + batch.num_rows)
            columns, shared = [pa.array(place)], np.ones(batch.num_rows, bool)
            for run, keys in runs.items():
                begins = _changes(batch, keys, last and [last[k] for k in keys])
                if not done:
                    begins[0] = False
                firsts = np.where(begins, place, -1)
                firsts[0] = max(firsts[0], starts[run])
                firsts = np.maximum.accumulate(firsts)
                starts[run] = int(firsts[-1])
                columns.append(pa.array(firsts))
                # Alone if it differs from both neighbours; a border counts as the same.
                shared = ~(begins & np.append(begins[1:], False))
            tail = batch.slice(batch.num_rows - 1).to_pylist()[0]
            last = {k: tail[k] for k in order}
            done += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, pa.array(shared)], names)

    table = store.put(name, sorted_rows.mapInArrow(number, schema))
    keys = F.struct(*order)
    parts = (
        table.groupBy("_part").agg(
            F.count("*").alias("rows"),
            F.min_by(keys, "_row").alias("first"),
            F.max_by(keys, "_row").alias("last"),
            *[F.max_by(column, "_row").alias(column) for column in local.values()],
        ).orderBy("_part").collect()
    )
    offset, before, carry, borders = 0, None, dict.fromkeys(runs, 0), []
    for part in parts:
        for run, columns in runs.items():
            if before is None or any(before[c] != part["first"][c] for c in columns):
                carry[run] = offset
        borders.append((part["_part"], offset, *[carry[run] for run in runs]))
        for run, column in local.items():
            if part[column] >= 0:
                carry[run] = offset + part[column]
        offset, before = offset + part["rows"], part["last"]
    carried = [f"_carry_{run}" for run in runs]
    ddl = ", ".join(f"{c} long" for c in ["_part", "_offset", *carried])
    # One row of numbers for each partition.
    known = F.broadcast(frame.sparkSession.createDataFrame(borders, ddl))
    placed = table.join(known, "_part").withColumns({
        "at": F.col("_offset") + F.col("_row"),
        **{
            run: F.when(F.col(column) < 0, F.col(f"_carry_{run}"))
            .otherwise(F.col("_offset") + F.col(column))
            for run, column in local.items()
        },
    })
    return placed.drop("_part", "_row", "_offset", *carried, *local.values())
