"""Ordered, comma-joined lists per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.operators.ordering import range_parts


def _joined(df: DataFrame, keys: list[str], order: list[str], item: str) -> DataFrame:
    entries = F.sort_array(F.collect_list(F.struct(*dict.fromkeys([*order, item]))))
    return df.groupBy(*keys).agg(entries.alias("entries")).select(
        *keys,
        F.array_join(F.transform("entries", lambda e: e[item].cast("string")), ",").alias("list"),
        F.size("entries").cast("long").alias("num"),
    )


def list_pieces(items: DataFrame, key: str, order: list[str], item: str) -> DataFrame:
    """The lists in pieces: key, part, list, num. Pieces of a key follow `part`.

    Rows are spread evenly over parts, so a piece has a part's rows at most, however long the list of
    its key. This is the form without a bound on the length of a list.
    """
    parts = range_parts(items, list(dict.fromkeys([key, *order, item])))
    return _joined(parts, [key, "part"], order, item)


def ordered_lists(items: DataFrame, key: str, order: list[str], item: str) -> DataFrame:
    """Per key the items in `order`, comma-joined (`list`), and how many (`num`).

    `items` has one row per key and item. The list of a key is one cell, so one task has to make it
    and 2 GB are its limit; `list_pieces` has neither.
    """
    return _joined(items, [key], order, item)
