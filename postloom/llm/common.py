"""Helpers the operators share: reading tables, shipping code to workers, bounded samples, noise."""

from __future__ import annotations

import io
import itertools
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import postloom
from postloom.session import store

ROWS_PER_FILE = 100_000
# The archives handed to each application's file server; they must last as long as the driver.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of `spark`, wherever they start."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(postloom.__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, files in sorted(os.walk(root)):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("postloom", os.path.relpath(full, root)))
    # The driver's file server hands the archive to the executors, whenever one starts.
    folder = tempfile.TemporaryDirectory()
    path = os.path.join(folder.name, f"postloom-{app}.zip")
    with open(path, "wb") as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped[app] = folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def doc_fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 3; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def hash_sample(rows: DataFrame, stratum: str, identity: list[str], per_stratum: int) -> DataFrame:
    """At most `per_stratum` rows of each stratum, evenly spread and the same in every run.

    Rows fall into `per_stratum` hash bins of their stratum and each bin gives the row of the
    smallest hash of `identity`: one aggregate that reads and combines those columns only, whatever
    the size of a stratum. Among rows of one identity the smallest row is taken.
    """
    columns = rows.columns
    hashed = rows.withColumn("_h", F.xxhash64(*identity, F.lit(71))).withColumn("_bin", F.pmod(F.xxhash64("_h"), F.lit(per_stratum)))
    # Stored, so that Spark knows how small it is and need not shuffle the rows to meet it.
    least = store(hashed.groupBy(F.col(stratum).alias("_s"), F.col("_bin").alias("_b")).agg(F.min("_h").alias("_least")), "sample")
    found = hashed.join(
        least, hashed[stratum].eqNullSafe(least["_s"]) & (hashed["_bin"] == least["_b"]) & (hashed["_h"] == least["_least"]), "left_semi"
    )
    one = found.groupBy("_bin", "_h", F.col(stratum).alias("_s")).agg(F.min(F.struct(*columns)).alias("_row"))
    return one.select("_row.*")


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The groups of batches that are sorted by whole-number keys, each in one batch."""
    rest: pa.Table | None = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            new = pa.Table.from_batches([batch])
            rest = new if rest is None else pa.concat_tables([rest, new])
        if rest is None or not rest.num_rows:
            continue
        marks = np.stack([rest.column(k).to_numpy() for k in keys])
        cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist()]
        ends = [*cuts[1:], rest.num_rows]
        # The last group may go on in the next batch.
        for start, end in list(zip(cuts, ends))[: None if batch is None else -1]:
            yield rest.slice(start, end - start).combine_chunks().to_batches()[0]
        rest = rest.slice(cuts[-1])


def few(df: DataFrame, rows: int) -> DataFrame:
    """`df` in as many partitions as about so many rows need: small results as few files."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))


_GOLDEN, _MUL_1, _MUL_2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose outputs look random (the SplitMix64 finaliser)."""
    z = values + _GOLDEN
    z = (z ^ (z >> np.uint64(30))) * _MUL_1
    z = (z ^ (z >> np.uint64(27))) * _MUL_2
    return z ^ (z >> np.uint64(31))


def uniform(values: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1, a pure function of the given 64-bit keys."""
    return ((mix64(values) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
