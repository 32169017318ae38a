"""Records of SQL dump text whose quoted values may hold line breaks.

Whether a line starts inside a quoted value depends on everything before it in its file. So
each line is a move of a small state machine (outside quotes, inside a quoted value, inside a
block comment): what state it ends in for each state it may start in. The moves of a file's
blocks, which Spark reads side by side, are composed to one move for each block, these are
composed along each file, and so every block learns the state it starts in. A second reading
joins the lines of one value. What reaches over the end of a block comes out as pieces, two
for a block at most, which are put together by file and place.

Both readings see the same blocks: they come from one frame, whose files are listed once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OUT, QUOTE, COMMENT = range(3)
STATES = (OUT, QUOTE, COMMENT)
# A move is a number of three digits of base 3: where each state leads to.
MOVES = [(a, b, c) for c in STATES for b in STATES for a in STATES]
STAY = MOVES.index(STATES)
# What two moves make one after the other, and where a move leads from a state.
THEN = [MOVES.index(tuple(second[s] for s in first)) for first in MOVES for second in MOVES]
LEADS = [move[s] for move in MOVES for s in STATES]
# Kinds of text that the second reading gives: whole, or a piece that starts a record, lies
# within one or ends one.
WHOLE, START, WITHIN, END = range(4)

# Characters of a record that is put together from several blocks.
LONGEST_RECORD = 1 << 28
# Rows and bytes of a batch that the second reading gives.
BATCH_ROWS, BATCH_BYTES = 5000, 4 << 20
PIECES_SQL = "value string, file string, block bigint, kind int"


def _odd_quotes(text: Column) -> Column:
    """Whether a text opens or closes a quoted value; doubled quotes do both."""
    bare = F.regexp_replace(text, r"(?s)\\.", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit("'"), F.lit("")))
    return quotes % 2 == 1


def line_move(line: Column) -> Column:
    """The move of a line. Comments count where a line starts with them, outside of quotes."""
    start = F.ltrim(line)
    end, end_of_line = F.locate("*/", start, 3), F.locate("*/", line)

    def rest(text: Column, at: Column) -> Column:
        return F.when(_odd_quotes(F.substr(text, at + 2)), QUOTE).otherwise(OUT)

    odd = _odd_quotes(line)
    outside = (
        F.when(start.startswith("--"), OUT)
        .when(start.startswith("/*"), F.when(end == 0, COMMENT).otherwise(rest(start, end)))
        .otherwise(F.when(odd, QUOTE).otherwise(OUT))
    )
    inside = F.when(odd, OUT).otherwise(QUOTE)
    comment = F.when(end_of_line == 0, COMMENT).otherwise(rest(line, end_of_line))
    plain = ~(line.contains("'") | line.contains("/*") | line.contains("*/"))
    return F.when(plain, STAY).otherwise(outside + 3 * inside + 9 * comment).cast("int")


def lines_with_moves(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, block, place in it and move."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        line_move(F.col("value")).alias("move"),
    )


def block_starts(lines: DataFrame) -> DataFrame:
    """The state in which each block starts: one row for each block that Spark reads."""
    moving = F.when(F.col("move") != STAY, F.struct("place", "move"))
    blocks = lines.groupBy("file", "block").agg(F.array_sort(F.collect_list(moving)).alias("moves"))
    then, leads = F.lit(THEN), F.lit(LEADS)
    composed = F.aggregate(
        "moves", F.lit(STAY), lambda done, next_: F.get(then, done * len(MOVES) + next_["move"])
    )
    in_file = F.array_sort(F.collect_list(F.struct("block", composed.alias("move"))))
    files = blocks.groupBy("file").agg(in_file.alias("blocks"))
    kind = "struct<state:int,starts:array<struct<block:bigint,state:int>>>"
    first = F.struct(F.lit(OUT).alias("state"), F.array().alias("starts")).cast(kind)

    def along(done: Column, block: Column) -> Column:
        here = F.struct(block["block"].alias("block"), done["state"].alias("state"))
        to = F.get(leads, block["move"] * len(STATES) + done["state"])
        return F.struct(to.alias("state"), F.concat(done["starts"], F.array(here)).alias("starts")).cast(kind)

    starts = F.aggregate("blocks", first, along)["starts"]
    return files.select("file", F.inline(starts)).withColumnRenamed("state", "starts_in")


class _Joiner:
    """Joins the lines of one block's records; what is left open at its ends are pieces."""

    def __init__(self) -> None:
        self.where: tuple[str, int] | None = None
        self.state, self.held, self.open_before = OUT, [], False

    def begin(self, where: tuple[str, int], state: int) -> None:
        self.where, self.state, self.held = where, state, []
        self.open_before = state != OUT

    def end(self) -> Iterator[tuple[str, str, int, int]]:
        if self.held:
            yield "\n".join(self.held), *self.where, WITHIN if self.open_before else START
        self.held = []

    def lines(self, values: pa.Array, moves: np.ndarray) -> Iterator[pa.Array | tuple]:
        """Runs of whole lines as they are, and joined records or pieces one by one."""
        to = np.array(LEADS).reshape(-1, len(STATES))[moves]
        changes = [np.append(np.flatnonzero(to[:, s] != s), len(values)) for s in STATES]
        i, n = 0, len(values)
        while i < n:
            left = changes[self.state]
            stop = int(left[np.searchsorted(left, i)])
            if self.state == OUT:
                if stop > i:
                    yield values.slice(i, stop - i)
                if stop < n:
                    self.held, self.state = [values[stop].as_py()], int(to[stop, OUT])
                i = stop + 1
                continue
            self.held += values.slice(i, stop + 1 - i).to_pylist()
            if stop < n:
                self.state = int(to[stop, self.state])
                if self.state == OUT:
                    kind = END if self.open_before else WHOLE
                    yield "\n".join(self.held), *(self.where if kind else (None, None)), kind
                    self.held, self.open_before = [], False
            i = stop + 1


class _Gathered:
    """Runs and single records as batches of some thousand rows, in the order in which they come."""

    def __init__(self) -> None:
        self.values, self.marks, self.size = [], [], 0

    def add(self, values: pa.Array, file: str | None = None, block: int | None = None, kind: int = WHOLE):
        self.values.append(values)
        self.marks += [(file, block, kind)] * len(values)
        self.size += values.nbytes

    def ready(self, most: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
        if self.marks and (len(self.marks) >= most or self.size >= size):
            file, block, kind = zip(*self.marks)
            columns = [pa.concat_arrays(self.values), pa.array(file, pa.string()),
                       pa.array(block, pa.int64()), pa.array(kind, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["value", "file", "block", "kind"])
            self.values, self.marks, self.size = [], [], 0


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    joiner, out = _Joiner(), _Gathered()

    def given(found: Iterator) -> Iterator[pa.RecordBatch]:
        for one in found:
            if isinstance(one, pa.Array):
                out.add(one)
            else:
                out.add(pa.array([one[0]], pa.string()), *one[1:])
            yield from out.ready()

    for batch in batches:
        values, moves = batch.column(0).cast(pa.string()), batch.column(3).to_numpy()
        files = batch.column(1).dictionary_encode()
        ids, blocks = files.indices.to_numpy(), batch.column(2).to_numpy()
        cuts = np.flatnonzero((np.diff(ids) != 0) | (np.diff(blocks) != 0)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            if a == b:
                continue
            where = (files.dictionary[int(ids[a])].as_py(), int(blocks[a]))
            if where != joiner.where:
                yield from given(joiner.end())
                joiner.begin(where, batch.column(4)[a].as_py())
            yield from given(joiner.lines(values.slice(a, b - a), moves[a:b]))
    yield from given(joiner.end())
    yield from out.ready(0)


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """value, file, block, kind: records (kind 0) and pieces of those that reach over blocks."""
    lines = lines_with_moves(spark, path)
    # One row for each block, of which Spark's driver keeps a list anyway.
    starts = F.broadcast(block_starts(lines))
    known = lines.join(starts, ["file", "block"], "left").select(
        "value", "file", "block", "move",
        F.coalesce("starts_in", F.raise_error(F.lit("the files changed while they were read"))),
    )
    return known.mapInArrow(_records, PIECES_SQL)


def joined_pieces(pieces: DataFrame, longest: int = LONGEST_RECORD) -> DataFrame:
    """value: the records that pieces make up, in the order of their blocks.

    Pieces of a record that is never closed, or longer than ``longest`` characters, are given
    line by line instead: a stray quote must not gather the rest of its file in one task.
    """
    along = Window.partitionBy("file").orderBy("block", F.desc("kind"))
    number = F.sum(F.when(F.col("kind") == START, 1).otherwise(0)).over(along).alias("record")
    open_ = pieces.filter(F.col("kind") != WHOLE)
    narrow = open_.select("file", "block", "kind", F.length("value").alias("n"), number)
    record = Window.partitionBy("file", "record")
    closed = F.max(F.col("kind") == END).over(record) & F.max(F.col("kind") == START).over(record)
    known = narrow.select(
        "file", "block", "kind", "record", (closed & (F.sum("n").over(record) <= longest)).alias("one")
    )
    numbered = open_.join(known, ["file", "block", "kind"])
    parts = F.array_sort(F.collect_list(F.struct("block", (-F.col("kind")).alias("after"), "value")))
    texts = F.transform(parts, lambda part: part["value"])
    whole = numbered.filter("one").groupBy("file", "record").agg(F.array_join(texts, "\n").alias("value"))
    lines = numbered.filter("not one").select(F.explode(F.split("value", "\n")).alias("value"))
    return whole.select("value").unionByName(lines)


def read_dump_records(spark: SparkSession, path: str) -> DataFrame:
    """value: lines of dump text, those of one quoted value joined; blank ones left out.

    A value comes out whole and once, however many lines and blocks it reaches over. The
    files are read three times, the first time for the lines' moves only; a job that keeps
    what ``read_pieces`` gives reads them twice.
    """
    pieces = read_pieces(spark, path)
    records = pieces.filter(F.col("kind") == WHOLE).select("value").unionByName(joined_pieces(pieces))
    return records.filter(F.btrim("value", F.lit(" \t\r\n\f\v")) != "")
