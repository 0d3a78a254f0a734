"""Products as tab-separated text, quoted or with one line per row, and as Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions.text import known, to_long
from postloom.schemas import PRODUCTS
from postloom.session import delete, exists, move

TSV_OPTIONS = {"header": "true", "sep": "\t", "encoding": "UTF-8", "escape": '"'}
# Cells without line breaks, tabs or quotation: one line is one row, so Spark can split a file anywhere.
LINE_OPTIONS = {"header": "true", "sep": "\t", "encoding": "UTF-8", "quote": "", "escape": "\u0000"}
# Spark cannot split a packed file: one task reads so many rows of it at most.
ROWS_PER_PACKED_FILE = 100_000
_ESCAPES = {"%": "%25", "\n": "%0A", "\r": "%0D", "\t": "%09", "\0": "%00"}


def _escaped(text: Column) -> Column:
    for plain, escape in _ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(escape))
    return text


def _restored(text: Column) -> Column:
    for plain, escape in reversed(_ESCAPES.items()):
        text = F.replace(text, F.lit(escape), F.lit(plain))
    return text


def write_tsv(df: DataFrame, path: str, folders: Sequence[str] = ()) -> None:
    """Quoted text: a cell may hold line breaks, so a file is read by one task."""
    df.write.partitionBy(*folders).options(
        **TSV_OPTIONS, emptyValue="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)


def write_lines(df: DataFrame, path: str, folders: Sequence[str] = (), **options: str | int) -> None:
    """Text with one line per row: tabs, line ends, NUL and "%" in cells are written as "%" and two
    hexadecimal digits, and nothing is quoted."""
    cells = [_escaped(F.col(f"`{c}`")).alias(c) if kind == "string" and c not in folders else F.col(f"`{c}`") for c, kind in df.dtypes]
    df.select(*cells).write.partitionBy(*folders).options(
        **LINE_OPTIONS, emptyValue="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", **options
    ).csv(path)


def write_packed(df: DataFrame, path: str, folders: Sequence[str] = ()) -> None:
    """The same lines in gzip files of a bounded number of rows, for products whose rows repeat long texts."""
    write_lines(df, path, folders, compression="gzip", maxRecordsPerFile=ROWS_PER_PACKED_FILE)


def write_product(df: DataFrame, path: str, form: str = "parquet", folders: Sequence[str] = ()) -> None:
    """A product; `folders` are columns that become folders in place of columns.

    Forms: "parquet"; "tsv", quoted text; "lines", text that Spark can split; "packed", lines in gzip files.
    """
    if form == "parquet":
        df.write.partitionBy(*folders).parquet(path)
    else:
        {"tsv": write_tsv, "lines": write_lines, "packed": write_packed}[form](df, path, folders)


def replace_product(df: DataFrame, path: str, form: str = "parquet", folders: Sequence[str] = ()) -> None:
    """A product in place of the one that may be at `path`; `df` may read the old one.

    It is written beside and then takes the place by renaming folders, so a reader finds the old files
    or the new ones, never some of both, and a job that fails leaves the old ones.
    """
    spark, mark = df.sparkSession, uuid4().hex
    fresh, old = f"{path.rstrip('/')}-new-{mark}", f"{path.rstrip('/')}-old-{mark}"
    write_product(df, fresh, form, folders)
    if not exists(spark, path):
        move(spark, fresh, path)
        return
    move(spark, path, old)
    try:
        move(spark, fresh, path)
    except Exception:
        move(spark, old, path)
        raise
    delete(spark, old)


def _read_text(texts: DataFrame, product: str, strict: bool, restored: bool) -> DataFrame:
    def column(name: str, kind: str) -> Column:
        text = known(F.col(f"`{name}`"))
        if kind == "string":
            return (_restored(text) if restored else text).alias(name)
        number = to_long(text)
        if strict:
            number = F.coalesce(number, F.raise_error(F.lit(f"missing value in number column {name}")).cast("long"))
        return number.cast(kind).alias(name)

    return texts.select(*[column(n, kind) for n, kind in PRODUCTS[product].items() if n in texts.columns])


def read_tsv(spark: SparkSession, path: str, product: str, strict: bool = True) -> DataFrame:
    """A product in quoted text, by its contract. `strict` raises on a missing number in a number column."""
    return _read_text(spark.read.options(**TSV_OPTIONS, multiLine="true").csv(path), product, strict, False)


def read_lines(spark: SparkSession, path: str, product: str, strict: bool = True) -> DataFrame:
    """A product written by `write_lines` or `write_packed`, by its contract; a large file of lines is read by many tasks."""
    return _read_text(spark.read.options(**LINE_OPTIONS).csv(path), product, strict, True)


def preview(df: DataFrame, order: list[str], rows: int = 3_000) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(rows)
