"""Posts with their topic and the engagement counters of the topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import clean
from postloom.operators.enrich import look_up
from postloom.schemas import CONTENT_RAW
from postloom.session import store

COUNTED = ("praise", "reply", "forward")
COUNTERS = tuple(f"topic_{c}_count" for c in COUNTED)
TEXTS = ("desc", "introduction", "content_title", "topic_title")


def _named_posts(posts: DataFrame) -> DataFrame:
    return posts.withColumnsRenamed(
        {"id": "content_id", "subject_id": "topic_id", "title": "content_title", "create_time": "content_create_time"}
    )


def _topic_attributes(topics: DataFrame) -> DataFrame:
    return topics.selectExpr("id AS topic_id", "title AS topic_title", "introduction", "create_time AS topic_create_time")


def _product(joined: DataFrame) -> DataFrame:
    """The content columns there are, in file order, with clean texts and 0 for a missing topic time."""
    columns = [c for c in CONTENT_RAW if c in joined.columns]
    return joined.na.fill(0, subset=["topic_create_time"]).select(
        *[clean(F.col(c)).alias(c) if c in TEXTS else c for c in columns]
    )


def with_topic(posts: DataFrame, topics: DataFrame) -> DataFrame:
    """Each post with title, introduction and time of its topic; texts cleaned."""
    return _product(look_up(_named_posts(posts), _topic_attributes(topics), "topic_id"))


def topic_counters(posts: DataFrame, topics: DataFrame) -> DataFrame:
    """One row per topic of a post (null included): sums of its posts' counts, as they count after
    the topic join. A null topic counts nothing; null counts are left out."""
    sums = posts.groupBy(F.col("subject_id").alias("topic_id")).agg(
        *[F.sum(f"{c}_count").alias(f"{c}_sum") for c in COUNTED]
    )
    copies = topics.groupBy(F.col("id").alias("topic_id")).agg(F.count("*").alias("copies"))
    return look_up(sums, copies, "topic_id").selectExpr(
        "topic_id",
        *[
            f"CASE WHEN topic_id IS NULL THEN 0L ELSE coalesce({c}_sum * coalesce(copies, 1L), 0L) END"
            f" AS topic_{c}_count"
            for c in COUNTED
        ],
    )


def content_raw(posts: DataFrame, topics: DataFrame) -> DataFrame:
    """Posts with topic and topic counters.

    Counters and topic texts form one small stored table, a row per topic, so the posts with their
    long texts are joined once: by broadcast as long as that table is under Spark's size threshold.
    """
    side = store(look_up(topic_counters(posts, topics), _topic_attributes(topics), "topic_id"), "topics")
    return _product(look_up(_named_posts(posts), side, "topic_id"))
