"""The app's CSV exports as typed DataFrames."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postloom.functions.text import known, to_long
from postloom.schemas import POSTS, TOPICS, USER_ACTION, USERS
from postloom.session import settings
from postloom.sources.records import records

# Tasks get the functions themselves: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CSV_OPTIONS = {"header": "true", "sep": ",", "encoding": "UTF-8", "escape": '"'}
_END = "\u0001"


def typed(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """The contract's columns, by name, from a table of texts; missing tokens become null."""

    def column(name: str, kind: str) -> Column:
        text = known(F.col(f"`{name}`"))
        return (text if kind == "string" else to_long(text).cast(kind)).alias(name)

    return df.select(*[column(name, kind) for name, kind in contract.items()])


def _first_records(batches: Iterator[pa.RecordBatch], only_one: bool) -> Iterator[pa.RecordBatch]:
    """From lines in file order, the first record of each file: it ends where its quotes are closed.

    With `only_one` the task ends there, whatever else the file holds.
    """
    open_records: dict[str, list[str]] = {}
    found: dict[str, str] = {}
    for batch in batches:
        for file, line in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
            if file in found or not (line.strip() or file in open_records):
                continue
            record = open_records.setdefault(file, [])
            record.append(line)
            if sum(part.count('"') for part in record) % 2 == 0:
                found[file] = "\n".join(open_records.pop(file))
        if only_one and found:
            break
    for file, record in open_records.items():
        found[file] = "\n".join(record)
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.string())], names=["file", "header"])


def _plain(uri: str) -> str:
    """A file's path as it is spelt. Spark writes both "file:/a%20b" and "file:///a%20b"."""
    return re.sub(r"^file:/+", "file:///", unquote(uri))


def _literal(path: str) -> str:
    """A path whose characters stand for themselves, not for a pattern."""
    return re.sub(r"([][{}*?\\])", r"\\\1", path)


def _files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of `path`, together where their header lines agree.

    One job reads the first record of all files, a task each and no further than that; Spark's reader
    then names the columns of each kind of record. What comes to the driver is a line per file.
    """


    def first_records(paths: str | list[str], only_one: bool) -> dict[str, str]:
        lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value")
        heads = lines.mapInArrow(lambda batches: _first_records(batches, only_one), "file string, header string").collect()
        return {_plain(row["file"]): row["header"] for row in heads}

    files = [_plain(f) for f in spark.read.text(path).inputFiles()]
    whole = str(1 << 50)  # no file is cut, none shares a task
    with settings(spark, spark__sql__files__maxPartitionBytes=whole, spark__sql__files__openCostInBytes=whole):
        headers = first_records(path, True)
    # Empty files, and files that shared a task all the same.
    if missing := [f for f in files if f not in headers]:
        headers |= first_records([_literal(f) for f in missing], False)
    files_of: dict[str, list[str]] = {}
    for file in files:
        if file in headers:
            files_of.setdefault(headers[file], []).append(file)
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, files in files_of.items():
        names = tuple(spark.read.options(**CSV_OPTIONS).csv(spark.sparkContext.parallelize([header], 1)).columns)
        groups.setdefault(names, []).extend(map(_literal, files))
    return groups


def _checked(spark: SparkSession, files: list[str], names: tuple[str, ...], multiline: bool) -> DataFrame:
    """All columns of files with one header as text, and `_too_long` for lines with too many fields.

    Spark fills short lines with nulls. It marks short and long lines alike, so a marked line is
    parsed again with one more column and an end mark as its last field: the mark is lost exactly
    when the line is too long.
    """
    schema = ", ".join(f"`{n}` string" for n in [*names, "_marked"])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_marked"}
    if multiline:
        parsed = F.from_csv("record", F.lit(schema), {"escape": '"', "multiLine": "true", **options})
        df = records(spark, files).select(parsed.alias("_parsed")).select("_parsed.*")
    else:
        df = spark.read.options(**CSV_OPTIONS, **options).schema(schema).csv(files)
    wider = ", ".join(f"f{i} string" for i in range(len(names) + 1))
    again = F.from_csv(F.concat("_marked", F.lit("," + _END)), F.lit(wider), {"escape": '"', "multiLine": "true"})
    fits = F.array_contains(F.array(*[again[f"f{i}"] for i in range(len(names) + 1)]), _END)
    too_long = F.col("_marked").isNotNull() & ~F.coalesce(fits, F.lit(False))
    # The marks alone cannot be read: Spark refuses a query, such as a bare count, without any field.
    reads_a_field = F.coalesce(F.length(f"`{names[0]}`"), F.lit(0)) >= 0
    return df.where(reads_a_field).withColumn("_too_long", too_long)


def read_export(
    spark: SparkSession, path: str, contract: dict[str, str], strict: bool, multiline: bool = True, optional: bool = False,
    counts: Observation | None = None,
) -> DataFrame:
    """The contract's columns of a CSV file, or of all files of a folder, each by its own header.

    A line with too many fields raises if `strict`. Otherwise it is left out, and `counts` receives
    how many lines there were (`lines`) and how many were left out (`lines_left_out`). A column that
    a file lacks raises; an `optional` contract takes it as missing, or leaves it out if no file has it.
    """
    groups = _files_by_header(spark, path)
    if not groups:
        raise ValueError(f"no header line in {path}")
    known_names = {n for names in groups for n in names}
    wanted = {c: kind for c, kind in contract.items() if c in known_names} if optional else contract
    parts = []
    for names, files in groups.items():
        rows = _checked(spark, files, names, multiline)
        absent = [c for c in wanted if c not in names] if optional else []
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else rows
        parts.append(rows.select(*[f"`{c}`" for c in wanted], "_too_long", F.col("_marked").alias("_line")))
    lines = reduce(DataFrame.unionByName, parts)
    if strict:
        refuse = F.raise_error(F.concat(F.lit("line with too many fields: "), "_line")).cast("boolean")
        kept = lines.where(F.when(F.col("_too_long"), refuse).otherwise(F.lit(True)))
    else:
        if counts is not None:
            lines = lines.observe(counts, F.count("*").alias("lines"), F.count_if("_too_long").alias("lines_left_out"))
        kept = lines.where(~F.col("_too_long"))
    return typed(kept, wanted)


def read_user_action(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """The event log; a line with too many fields raises. Cells may hold line breaks, and large files are
    split all the same; `multiline=False`, where no cell does, saves the passes that takes."""
    return read_export(spark, path, USER_ACTION, True, multiline)


def read_posts(
    spark: SparkSession, path: str, strict: bool = False, multiline: bool = True, counts: Observation | None = None
) -> DataFrame:
    return read_export(spark, path, POSTS, strict, multiline, counts=counts)


def read_topics(
    spark: SparkSession, path: str, strict: bool = False, multiline: bool = True, counts: Observation | None = None
) -> DataFrame:
    return read_export(spark, path, TOPICS, strict, multiline, counts=counts)


def read_users(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """The users, as text; a line with too many fields raises, a column that no file has is left out."""
    return read_export(spark, path, USERS, True, multiline, optional=True)
