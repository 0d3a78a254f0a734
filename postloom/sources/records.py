"""CSV records whose quoted cells may hold line breaks, read from files that Spark splits anywhere.

A line break ends a record only outside quotes, and whether a line begins inside them depends on all that
stands before it. But each line only does one of few things to that state: it maps "outside" and "inside"
at its start to one of these at its end. Such maps compose, so a first pass folds the lines of each block of
a file into one map, a row per block; strung together per file these give the state in which each block
begins. The second pass puts the records of each block together. What a block's ends cut off, at most two
pieces of a block, is joined to whole records by an aggregate over these pieces alone.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.session import store

# Tasks get the functions themselves: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTSIDE, INSIDE = 0, 1
# A quoted cell with what follows up to the separator, or a plain one, in which quotes mean nothing.
_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+)'
_CLOSED = re.compile(rf"(?:{_CELL},)*+{_CELL}\Z")
_BLANK = re.compile(r"[\x00-\x20]*")
_REST = re.compile(r'[^"]*+(?:""[^"]*+)*+"(?!")[^,]*+')


def state_after(line: str, state: int) -> int:
    """Whether a line that begins in a state ends inside a quoted cell."""
    if '"' not in line:
        return state
    if state == INSIDE:
        rest = _REST.match(line)
        if rest is None:
            return INSIDE
        if rest.end() == len(line):
            return OUTSIDE
        line = line[rest.end() + 1 :]
    return OUTSIDE if _CLOSED.match(line) else INSIDE


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of blocks, in order: per block the state at its end for either state at its start."""
    block, states = None, (OUTSIDE, INSIDE)

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([block[0]], pa.string()), pa.array([block[1]], pa.int64()), pa.array([states[0]], pa.int32()), pa.array([states[1]], pa.int32())],
            names=["file", "block", "if_outside", "if_inside"],
        )

    for batch in batches:
        for file, start, line in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("value").to_pylist()):
            if (file, start) != block:
                if block is not None:
                    yield told()
                block, states = (file, start), (OUTSIDE, INSIDE)
            if '"' in line:
                outside, inside = state_after(line, OUTSIDE), state_after(line, INSIDE)
                states = tuple(inside if s else outside for s in states)
    if block is not None:
        yield told()


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of blocks, in order, with the state at the start of their block: whole records, and the pieces
    that a block's ends cut off. A piece that does not begin a record has `begins` false; `header` marks
    what begins the first record of a file. Blank records are left out."""
    block, state, held, begins, headed = None, OUTSIDE, [], True, True
    out: list[tuple[str, int, bool, bool, bool, str]] = []

    def close(whole: bool) -> None:
        nonlocal held, begins, headed
        record = "\n".join(held)
        if held and not (whole and begins and _BLANK.fullmatch(record)):
            out.append((*block, whole and begins, begins, not headed, record))
            headed = True
        held, begins = [], True

    def told() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string())
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
        return pa.RecordBatch.from_arrays(columns, names=["file", "block", "whole", "begins", "header", "record"])

    for batch in batches:
        names = ("file", "block", "state", "value")
        for file, start, at_start, line in zip(*(batch.column(c).to_pylist() for c in names)):
            if (file, start) != block:
                close(False)
                block, state, begins, headed = (file, start), at_start, at_start == OUTSIDE, start > 0
            held.append(line)
            state = state_after(line, state)
            if state == OUTSIDE:
                close(True)
        yield told()
        out.clear()
    close(False)
    yield told()


def records(spark: SparkSession, files: list[str]) -> DataFrame:
    """The column `record`: all records of the files but the first of each, which is its header and begins
    in the first block.

    Blank lines between records are left out. Lines end in "\\n" or "\\r\\n". The text of a record that no
    quote closes goes on to the end of its file.
    """
    lines = spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.regexp_replace("value", r"\r\z", "").alias("value")
    )
    # A row per block; the states of a file's blocks follow from each other in order.
    maps = store(lines.mapInArrow(_fold, "file string, block long, if_outside int, if_inside int"), "csv-blocks")
    chain = F.sort_array(F.collect_list(F.struct("block", "if_outside", "if_inside")))
    states = maps.groupBy("file").agg(chain.alias("chain")).select(
        "file",
        F.explode(
            F.expr(
                "aggregate(chain, struct(0 AS state, array(struct(0L AS block, 0 AS state)) AS found), (a, b) -> struct("
                "if(a.state = 0, b.if_outside, b.if_inside) AS state, concat(a.found, array(struct(b.block AS block, a.state AS state))) AS found),"
                " a -> slice(a.found, 2, size(a.found)))"
            )
        ).alias("at"),
    ).select(F.col("file").alias("of"), F.col("at.block").alias("begin"), F.col("at.state").alias("state"))
    states = store(states, "csv-states")
    # Numbered before the join, so that the order of lines survives whatever join Spark takes.
    numbered = lines.withColumn("line", F.monotonically_increasing_id())
    placed = numbered.join(states, (F.col("file") == F.col("of")) & (F.col("block") == F.col("begin"))).sortWithinPartitions("file", "block", "line")
    parts = placed.select("file", "block", "state", "value").mapInArrow(_assemble, "file string, block long, whole boolean, begins boolean, header boolean, record string")
    parts = store(parts, "csv-records")
    pieces = parts.where(~F.col("whole")).withColumn("number", F.expr("sum(int(begins)) OVER (PARTITION BY file ORDER BY block, begins)"))
    joined = pieces.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "begins", "record"))).alias("pieces"), F.max("header").alias("header"))
    joined = joined.where(~F.col("header")).select(F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record"))
    return parts.where(F.col("whole") & ~F.col("header")).select("record").unionByName(joined)
