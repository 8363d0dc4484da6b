"""Lines of CSV files -> records, in splits of any file.

A quoted field may hold newlines, so a line need not be a record.  At the start
of a line a file is in one of two states: outside, or inside a quoted field.
A line, and so a whole split, is a function from the state before it to the
state after it.  The functions of the splits (one small row each) are composed
along every file, which tells each split its state at the start; it can then
be cut at true record starts without reading what comes before it.  The few
records that cross a split are put together from their pieces.

A quote opens a field only as the field's first character, so a stray quote
inside a text (``5" pipe``) changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A complete quoted field at a field's start; the same pattern for Java and Python.
_WHOLE = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'
_OPEN = r'(^|,)"'
_WHOLE_BYTES, _OPEN_BYTES = re.compile(_WHOLE.encode()), re.compile(_OPEN.encode())

#: What a row of ``cut_records`` is: a record, or a piece of one that crosses a split.
WHOLE, LAST_PIECE, FIRST_PIECE, MIDDLE_PIECE = range(4)


def ends_open(line: Column) -> Column:
    """Whether a line that starts a record ends inside a quoted field."""
    return F.contains(line, F.lit('"')) & F.regexp_replace(line, _WHOLE, "$1").rlike(_OPEN)


def state_after(line: bytes, inside: bool) -> bool:
    """Whether the line ends inside a quoted field, given whether it starts in one."""
    if b'"' not in line:
        return inside
    text = b'"' + line if inside else line
    return _OPEN_BYTES.search(_WHOLE_BYTES.sub(rb"\1", text)) is not None


def n_fields(record: Column) -> Column:
    """Number of fields of a record."""
    bare = F.regexp_replace(record, _WHOLE, "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def field_count(record: str) -> int:
    return _WHOLE_BYTES.sub(rb"\1", record.encode("utf-8", "surrogateescape")).count(b",") + 1


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, list[bytes]]]:
    """Lines of a partition by their split, in order; a split comes in several runs."""
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in columns)))
        lines = batch.column("line").to_pylist()
        at = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[at]:
                yield keys[at], lines[at:i]
                at = i


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start) -> the states after the split, from outside and from inside."""
    found: dict[tuple, tuple[bool, bool]] = {}
    for key, lines in _runs(batches, ["file", "start"]):
        outside, inside = found.get(key, (False, True))
        for line in lines:
            outside, inside = state_after(line, outside), state_after(line, inside)
        found[key] = outside, inside
    files, starts = [k[0] for k in found], [k[1] for k in found]
    yield pa.RecordBatch.from_arrays(
        [pa.array(files, pa.string()), pa.array(starts, pa.int64()), pa.array([v[0] for v in found.values()], pa.bool_()), pa.array([v[1] for v in found.values()], pa.bool_())],
        names=["file", "start", "from_outside", "from_inside"],
    )


def split_states(lines: DataFrame) -> DataFrame:
    """``lines`` (file, start, line binary, in the order of the file) -> (file, start, inside, closed):
    the state at the start of every split, and whether the file's last quoted field is closed."""
    functions = lines.mapInArrow(_functions, "file string, start long, from_outside boolean, from_inside boolean")
    # the state before a split: its file's earlier functions, applied in order (one small row per split)
    splits = functions.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("start", "from_outside", "from_inside"))).alias("splits"))
    follow = lambda state, split: F.when(state, split["from_inside"]).otherwise(split["from_outside"])
    states = F.aggregate(
        "splits", F.array(F.lit(False)), lambda states, split: F.concat(states, F.array(follow(F.element_at(states, -1), split)))
    )
    splits = splits.withColumn("states", states)
    closed = (~F.element_at("states", -1)).alias("closed")
    rows = splits.select("file", closed, F.explode(F.arrays_zip("splits.start", F.slice("states", F.lit(1), F.size("splits"))).alias("split")).alias("split"))
    return rows.select("file", F.col("split").getField("start").alias("start"), F.col("split").getField("1").alias("inside"), "closed")


class _Cutter:
    """Lines of one split, one after another -> its records and pieces of records."""

    def __init__(self, inside: bool, header_due: bool):
        self.inside = self.entered = inside  # entered: what is held began in an earlier split
        self.header_due, self.held, self.place = header_due, [], 0

    def add(self, line: bytes) -> tuple[int, int, bytes] | None:
        if not self.held and not self.inside and not line.strip():
            return None  # a blank line between records
        self.held.append(line)
        self.inside = state_after(line, self.inside)
        return None if self.inside else self.take(LAST_PIECE if self.entered else WHOLE)

    def take(self, what: int) -> tuple[int, int, bytes] | None:
        record, self.held, self.entered = b"\n".join(self.held), [], False
        self.place += 1
        if self.header_due:
            self.header_due = False
            return None
        return self.place, what, record

    def rest(self) -> tuple[int, int, bytes] | None:
        """A piece of a record that goes on in the next split."""
        return self.take(MIDDLE_PIECE if self.entered else FIRST_PIECE) if self.held else None


def records_of(lines: list[bytes]) -> tuple[list[bytes], bool]:
    """All records from the start of a file, the header among them, and whether the lines end within another one."""
    cutter = _Cutter(False, False)
    records = [found[2] for found in map(cutter.add, lines) if found]
    return records, bool(cutter.held)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(5)], names=["file", "start", "place", "what", "record"])

    split, cutter = None, None
    for now, lines in _runs(batches, ["file", "start", "inside"]):
        out: list[tuple] = []
        if now != split:
            if cutter and (left := cutter.rest()):
                out.append((*split[:2], *left))
            split, cutter = now, _Cutter(now[2], now[1] == 0)
        out += [(*split[:2], *found) for found in map(cutter.add, lines) if found]
        if out:
            yield rows(out)
    if cutter and (left := cutter.rest()):
        yield rows([(*split[:2], *left)])


def cut_records(lines: DataFrame, states: DataFrame, few_splits: bool) -> DataFrame:
    """``lines`` -> (file, start, place, what, record binary): all records but each file's header,
    blank lines left out, and the pieces of those that cross splits; ``start`` and ``place`` order
    a file's records.  ``states``: (file, start, inside) of the splits."""
    states = states.select(F.col("file").alias("_f"), F.col("start").alias("_s"), "inside")
    own = (F.col("file") == F.col("_f")) & (F.col("start") == F.col("_s"))
    if few_splits:  # a broadcast join keeps the lines of a split in order
        known = lines.join(F.broadcast(states), own)
    else:
        known = lines.withColumn("id", F.monotonically_increasing_id()).join(states, own)
        known = known.repartition("file", "start").sortWithinPartitions("file", "start", "id")
    return known.select("file", "start", "inside", "line").mapInArrow(_cut, "file string, start long, place long, what int, record binary")


def join_pieces(cut: DataFrame) -> DataFrame:
    """Puts records that cross splits together: at most two pieces per split take part."""
    by_file = Window.partitionBy("file").orderBy("start", "place")
    pieces = cut.where(F.col("what") != WHOLE).withColumn("nth", F.sum((F.col("what") == FIRST_PIECE).cast("int")).over(by_file))
    whole = pieces.groupBy("file", "nth").agg(F.sort_array(F.collect_list(F.struct("start", "place", F.col("record").cast("string").alias("record")))).alias("pieces"))
    joined = whole.select("file", F.col("pieces")[0]["start"].alias("start"), F.col("pieces")[0]["place"].alias("place"), F.array_join(F.col("pieces.record"), "\n").cast("binary").alias("record"))
    return cut.where(F.col("what") == WHOLE).select("file", "start", "place", "record").unionByName(joined)
