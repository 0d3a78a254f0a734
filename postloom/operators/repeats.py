"""Engagements per user, post and label, and the merge of repeated texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.functions.labels import MERGED_FLAGS
from postloom.functions.moments import first_of, moment, second_of
from postloom.functions.text import text_key


def engagements(labelled: DataFrame) -> DataFrame:
    """One row per user, post and label, with time and log id of its first and last log row.

    Everything downstream of the log derives from this table, so the log is read and shuffled once.
    """
    at = moment(F.col("created_at"), F.col("id"))
    first, last = F.col("first"), F.col("last")
    return (
        labelled.groupBy("user_id", "content_id", "follow")
        .agg(F.min(at).alias("first"), F.max(at).alias("last"))
        .select(
            "user_id", "content_id", "follow",
            first_of(first).alias("first_at"), second_of(first).alias("first_id"), first_of(last).alias("created_at"), second_of(last).alias("id"),
        )
    )


def _same_text(rows: DataFrame) -> DataFrame:
    """Per user and text: rows, and the OR of the flags. A null text is a group of its own."""
    return rows.groupBy("user_id", "desc_key").agg(
        F.count("*").alias("n"), *[F.max(flag).alias(f"any_{flag}") for flag in MERGED_FLAGS]
    )


def merge_flags(enriched: DataFrame) -> DataFrame:
    """Add `rep` and merge the flags of rows that repeat a text.

    A positive repeats when its user has another positive with the same text, null texts included.
    Repeated rows get the OR of each flag over the text; a null text equals none, so its rows get 0.
    Sums per text are joined back rather than taken in a window: partial sums fold a hot text on
    the map side, and adaptive execution can split a join but not a window. `enriched` is read
    twice, so it should be a stored table.
    """
    keyed = enriched.withColumn("desc_key", text_key(F.col("desc")))
    is_positive = F.col("follow") != "neg"
    groups = _same_text(keyed.where(is_positive)).select(
        F.col("user_id").alias("g_user"), F.col("desc_key").alias("g_key"), "n", *[f"any_{f}" for f in MERGED_FLAGS]
    )
    joined = keyed.join(
        groups,
        F.col("user_id").eqNullSafe(F.col("g_user")) & F.col("desc_key").eqNullSafe(F.col("g_key")),
        "left",
    )
    merged = joined.withColumn("rep", is_positive & (F.col("n") > 1))
    merged = merged.withColumns(
        {
            flag: F.when(F.col("rep") & F.col("desc").isNull(), F.lit(0))
            .when(F.col("rep"), F.col(f"any_{flag}"))
            .otherwise(F.col(flag))
            for flag in MERGED_FLAGS
        }
    )
    return merged.select(*enriched.columns, "rep")


def last_per_text(positives: DataFrame) -> DataFrame:
    """Positives merged to one row per user and text: merged flags, all else from the last row.

    The same result as `merge_flags` followed by "keep the last row". Time and log id lead, so "last"
    means latest; rows of one time and log id become one first, with the largest post and topic.
    `copies` says how many rows a row stands for, which counts when repeats are told from single rows.
    """
    keys = ["user_id", "desc_key"]
    keyed = positives.withColumns({"at": moment(F.col("created_at"), F.col("id")), "post": moment(F.col("content_id"), F.col("topic_id"))})
    flags = [F.max(flag).alias(flag) for flag in MERGED_FLAGS]
    single = keyed.groupBy(*keys, "at").agg(F.sum("copies").alias("n"), *flags, F.max("post").alias("post"))
    merged = single.groupBy(*keys).agg(F.sum("n").alias("n"), *flags, F.max_by("post", "at").alias("post"), F.max("at").alias("at"))
    no_text = (F.col("n") > 1) & F.col("desc_key").isNull()
    at, post = F.col("at"), F.col("post")
    return merged.select(
        *keys,
        *[F.when(no_text, F.lit(0)).otherwise(F.col(flag)).alias(flag) for flag in MERGED_FLAGS],
        F.lit(0).alias("neg"),
        first_of(at).alias("created_at"), second_of(at).alias("id"), first_of(post).alias("content_id"), second_of(post).alias("topic_id"),
    )
