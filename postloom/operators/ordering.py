"""Pieces of large groups, and positions in a total order, without one task ever holding a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.session import store

# Rows of a piece: what one task sorts or ranks at a time.
ROWS_PER_PIECE = 1_000_000


def pieces_per_key(rows: DataFrame, key: str, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """(key, pieces): rows / rows_per_piece rounded up, for the keys with more than one piece.

    The table is stored, so Spark knows its size when it picks the join with the rows.
    """
    counts = rows.groupBy(key).agg(F.ceil(F.count("*") / F.lit(rows_per_piece)).cast("int").alias("pieces"))
    return store(counts.where("pieces > 1"), "pieces")


def range_parts(df: DataFrame, order: list[str]) -> DataFrame:
    """Add `part`: rows are spread evenly over parts, and parts follow `order`.

    Duplicates of one order value share a part; apart from that no part grows with a key.
    """
    return df.repartitionByRange(*order).withColumn("part", F.spark_partition_id())


def running_totals(df: DataFrame, order: list[str], weights: dict[str, str]) -> DataFrame:
    """Add one column per weight, an SQL expression: its sum over all rows that come earlier in `order`.

    Parts in order are summed on their own; only the sums, one row per part, meet in one window.
    The parts are stored, so that both steps see the same ones. Rows of equal order come one after the
    other, as their numbers say, so that any number of them is spread over parts as well.
    """
    weighed = df.selectExpr("*", *[f"bigint({w}) AS _{n}" for n, w in weights.items()], "monotonically_increasing_id() AS _tie")
    order = [*order, "_tie"]
    parts = store(range_parts(weighed, order), "parts")
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    offsets = (
        parts.groupBy("part")
        .agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in weights])
        .selectExpr("part", *[f"sum(_{n}) OVER (ORDER BY part {earlier}) AS _{n}_offset" for n in weights])
    )
    in_part = f"PARTITION BY part ORDER BY {', '.join(f'`{c}`' for c in order)} {earlier}"
    # One row per part: bounded by the number of shuffle partitions.
    return parts.join(F.broadcast(offsets), "part").selectExpr(
        *[f"`{c}`" for c in df.columns],
        *[f"coalesce(_{n}_offset, 0L) + coalesce(sum(_{n}) OVER ({in_part}), 0L) AS {n}" for n in weights],
    )
