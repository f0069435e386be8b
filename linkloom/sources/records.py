"""Records of delimited text files, read by many tasks however long a file is.

A quoted field may hold line breaks, so whether a line begins a record depends on all text before
it. What a line does to that state is a function of two values, outside or inside quotes, and
functions compose. A first pass reads the lines of each block (the part of a file that one task
reads) and returns its composed function; the composition over blocks in order gives the state in
which each begins. The second pass then reads every block alone, and joins lines to records.
Records that go over the border of two blocks come out as pieces, which are put together at last.

The number of a record's first line, counted over all files in the order of their names, is its
place: one long, the same in every run over the same files.

Per block the driver gets a row of numbers: some 400,000 for 100 TB in blocks of 256 MB.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from linkloom.session import ship

# A quote that never closes would make one record of the rest of a file.
MAX_RECORD = 1 << 27

_WHOLE, _BEGINS, _GOES_ON = range(3)
# Lines keep the state, set it to either, or turn it round: state outside in bit 0, inside in bit 1.
_KEEPS, _TURNS = 2, 1


def _patterns(sep: str) -> tuple[str, str]:
    """Lines that end within quotes, for those that begin outside and for those that begin inside.

    A field is quoted if it begins with a quote; a doubled quote stands for one. What follows the
    closing quote up to the next separator is part of the field, as are quotes elsewhere. All
    repetitions are possessive, so that a long line needs no stack.
    """
    s = re.escape(sep)
    text = '[^"]*+(?:""[^"]*+)*+'
    field = f'(?:"{text}"[^{s}]*+|[^"{s}][^{s}]*+|)'
    opens = f'(?:{field}{s})*+"{text}\\z'
    return f"\\A{opens}", f'\\A{text}(?:\\z|"[^{s}]*+{s}{opens})'


@dataclass(frozen=True)
class Blocks:
    """For each block (hash of the file's path, first byte): the number of its first line, whether
    that lies within quotes, and whether the file's lines end with a carriage return; and how many of
    its lines end the record of the block before, and from which on they belong to the next one's."""

    starts: dict[tuple[int, int], tuple[int, bool, bool]]
    cuts: dict[tuple[int, int], tuple[int, int]]

    @property
    def broken(self) -> bool:
        """Whether some block begins within a record."""
        return any(inside for _, inside, _ in self.starts.values())


def _lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``file`` (a hash of its path), ``block``, ``turns``, ``cr`` and the ``line``."""
    outside, inside = _patterns(sep)
    line, quoted = F.col("value"), F.contains("value", F.lit('"'))
    turns = F.when(
        quoted, line.rlike(outside).cast("tinyint") + line.rlike(inside).cast("tinyint") * F.lit(2)
    ).otherwise(F.lit(_KEEPS)).cast("tinyint")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        turns.alias("turns"), F.endswith(line, F.lit("\r")).alias("cr"), line.alias("line"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """The parts of a batch that lie in one block: file and block, first row, row after the last."""
    file, block = (batch.column(c).to_numpy() for c in ("file", "block"))
    cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        if b > a:
            yield (int(file[a]), int(block[a])), a, b


def _after(turns: np.ndarray, inside: bool) -> np.ndarray:
    """The state after each line: the last line that sets it, turned round by those since."""
    sets = (turns == 0) | (turns == 3)
    turned = np.cumsum(turns == _TURNS)
    last = np.maximum.accumulate(np.where(sets, np.arange(len(turns)), -1))
    known = last >= 0
    base = np.where(known, turns[last] == 3, inside)
    return base ^ ((turned - np.where(known, turned[last], 0)) % 2 == 1)


def _before(after: np.ndarray, inside: bool) -> np.ndarray:
    return np.concatenate(([inside], after[:-1]))


_SUMS = {
    "file": pa.int64(), "block": pa.int64(), "lines": pa.int64(), "outside": pa.bool_(),
    "inside": pa.bool_(), "cr": pa.bool_(), "ends": pa.int64(), "opens": pa.int64(), "opens_in": pa.int64(),
}


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: the number of lines, its state if it began outside or inside, its first line's end;
    of how many lines a record that goes on from the block before has the end here (-1: none), and
    which line begins the last record of several lines (-1: none), for both states."""
    now, rows = None, []
    for batch in batches:
        turns, cr = batch.column("turns").to_numpy(), batch.column("cr")
        for key, a, b in _runs(batch):
            if key != now:
                now = key
                rows.append([*key, 0, False, True, cr[a].as_py(), -1, -1, -1])
            row = rows[-1]
            for state, opens in ((3, 7), (4, 8)):
                after = _after(turns[a:b], row[state])
                if len(begun := np.flatnonzero(~_before(after, row[state]) & after)):
                    row[opens] = row[2] + int(begun[-1])
                if state == 4 and row[6] < 0 and len(ended := np.flatnonzero(~after)):
                    row[6] = row[2] + int(ended[0]) + 1
                row[state] = bool(after[-1])
            row[2] += b - a
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(_SUMS.values())], list(_SUMS))


def _blocks(spark: SparkSession, path: str, lines: DataFrame) -> Blocks:
    files = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.xxhash64("_metadata.file_path").alias("file"),
    ).orderBy("path").collect()
    number = {r["file"]: i for i, r in enumerate(files)}
    found = lines.select("file", "block", "turns", "cr").mapInArrow(
        _summed, "file long, block long, lines long, outside boolean, inside boolean, cr boolean, "
        "ends long, opens long, opens_in long"
    ).collect()
    starts, cuts, before, n, inside, cr = {}, {}, None, 0, False, False
    for row in sorted(found, key=lambda r: (number[r["file"]], r["block"])):
        if row["file"] != before:
            before, inside, cr = row["file"], False, row["cr"]
        starts[row["file"], row["block"]] = (n, inside, cr)
        n += row["lines"]
        ends = 0 if not inside else row["ends"] if row["ends"] >= 0 else row["lines"]
        opens = row["opens_in"] if inside else row["opens"]
        inside = row["inside"] if inside else row["outside"]
        cuts[row["file"], row["block"]] = (ends, opens if inside and opens >= 0 else row["lines"])
    return Blocks(starts, cuts)


class _Open:
    """A block while its lines are read, and the record that is not yet complete."""

    def __init__(self, key: tuple[int, int], start: tuple[int, bool, bool], most: int):
        self.file, self.begin = key
        self.most = most
        self.place, self.inside, self.cr = start
        self.head = self.place if not self.begin else -1
        self.kind, self.first, self.lines, self.size = _GOES_ON, self.place, [], 0

    def add(self, at: int, line: str) -> None:
        if not self.lines:
            self.first = at
        self.lines.append(line[:-1] if self.cr and line.endswith("\r") else line)
        self.size += len(line)
        if self.size > self.most:
            self.too_long(self.first)

    def too_long(self, first: int) -> None:
        raise ValueError(f"a record of more than {self.most} letters: a quote in or before line "
                         f"{first + 1} of all files, counted from 1, is not closed")

    def take(self, kind: int) -> tuple:
        made = ("\n".join(self.lines), self.first, kind, self.first == self.head, self.file)
        self.lines, self.size = [], 0
        return made


_SHAPE = "record string, place long, kind int, head boolean, file long"
_KINDS = dict(zip(
    ["record", "place", "kind", "head", "file"],
    [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64()], strict=True,
))


def _rows(made: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x[i] for x in made], t) for i, t in enumerate(_KINDS.values())], list(_KINDS))


def _whole(blocks: Blocks, most: int):
    """The records that begin and end in one block."""

    def rows(state: _Open, text: pa.Array, first: np.ndarray) -> pa.RecordBatch:
        places = state.place + first
        return pa.RecordBatch.from_arrays([
            text, pa.array(places), pa.array(np.full(len(first), _WHOLE, np.int32)),
            pa.array(places == state.head), pa.array(np.full(len(first), state.file)),
        ], list(_KINDS))

    def bare(state: _Open, text: pa.Array) -> pa.Array:
        return pc.replace_substring_regex(text, "\r$", "") if state.cr else text

    def several(state: _Open, text: pa.Array, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The lines from each ``first`` to its ``last`` as one text."""
        many = last - first + 1
        ends = np.cumsum(many)
        at = np.arange(ends[-1]) + np.repeat(first - ends + many, many)
        lines = text.take(pa.array(at))
        sizes = np.add.reduceat(pc.utf8_length(lines).to_numpy(), ends - many)
        if (sizes > most).any():
            state.too_long(state.place + int(first[np.argmax(sizes > most)]))
        offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(offsets, bare(state, lines)), "\n")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            turns, text = batch.column("turns").to_numpy(), batch.column("line")
            for key, a, b in _runs(batch):
                if state is None or key != (state.file, state.begin):
                    state = _Open(key, blocks.starts[key], most)
                after = _after(turns[a:b], state.inside)
                before = _before(after, state.inside)
                lines = text[a:b]
                single = ~before & ~after
                yield rows(state, bare(state, lines.filter(pa.array(single))), np.flatnonzero(single))
                first, last = np.flatnonzero(~before & after), np.flatnonzero(before & ~after)
                if before[0]:
                    # A record that was begun before: all of the lines here, or those to its end.
                    end = int(last[0]) + 1 if len(last) else b - a
                    last = last[1:]
                    for i in range(end):
                        state.add(state.place + i, lines[i].as_py())
                    if not after[end - 1]:
                        made = state.take(_WHOLE)
                        if state.kind == _BEGINS:
                            yield _rows([made])
                begun, first = first[len(last):], first[:len(last)]
                if len(first):
                    yield rows(state, several(state, lines, first, last), first)
                if len(begun):
                    state.kind = _BEGINS
                    for i in range(int(begun[0]), b - a):
                        state.add(state.place + i, lines[i].as_py())
                state.inside, state.place = bool(after[-1]), state.place + b - a

    return join


def _pieces(blocks: Blocks, most: int):
    """The pieces of records that cross a border; the first pass has told which lines they are."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, at = None, 0
        for batch in batches:
            text = batch.column("line")
            for key, a, b in _runs(batch):
                if state is None or key != (state.file, state.begin):
                    if state and state.lines:
                        yield _rows([state.take(state.kind)])
                    state, at = _Open(key, blocks.starts[key], most), 0
                    ends, opens = blocks.cuts[key]
                for i in range(at, min(ends, at + b - a)):
                    state.add(state.place + i, text[a + i - at].as_py())
                if state.lines and ends <= at + b - a and state.kind == _GOES_ON:
                    yield _rows([state.take(_GOES_ON)])
                for i in range(max(opens, at), at + b - a):
                    state.kind = _BEGINS
                    state.add(state.place + i, text[a + i - at].as_py())
                at += b - a
        if state and state.lines:
            yield _rows([state.take(state.kind)])

    return cut


def read_records(
    spark: SparkSession, path: str, sep: str, max_record: int = MAX_RECORD
) -> DataFrame:
    """``record``, ``place`` and ``head`` (whether it is its file's first) of all records.

    A file is as its first line: if that ends with carriage return and line feed, such line breaks
    become line feeds, and bare line feeds end a record too. Quotes stay as they are. Empty lines
    are records. A record of more than ``max_record`` letters raises when it is read, as one
    quote that is never closed could make one record of all that follows in a file.
    """
    ship(spark)
    lines = _lines(spark, path, sep)
    blocks = _blocks(spark, path, lines)
    columns = ["record", "place", "head"]
    whole = lines.mapInArrow(_whole(blocks, max_record), _SHAPE).select(*columns)
    if not blocks.broken:
        return whole
    # At most two pieces for each block; a record's pieces are next to each other.
    inorder = Window.partitionBy("file").orderBy("place")
    first = F.max(F.when(F.col("kind") == _BEGINS, F.col("place"))).over(inorder)
    parts = lines.select("file", "block", "line").mapInArrow(
        _pieces(blocks, max_record), _SHAPE
    ).withColumn("_first", first)
    long = F.raise_error(F.concat(F.lit("a record is too long at line "), F.col("_first") + 1))
    put = parts.groupBy("_first").agg(
        F.sum(F.length("record")).alias("_size"),
        F.sort_array(F.collect_list(F.struct("place", "record"))).alias("parts"),
        F.max("head").alias("head"),
    ).where(F.when(F.col("_size") <= max_record, True).otherwise(long.cast("boolean"))).select(
        F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"),
        F.col("_first").alias("place"), "head",
    )
    return whole.unionByName(put)
