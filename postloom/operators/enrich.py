"""Post and topic lookups for interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.functions.labels import one_hot
from postloom.functions.text import clean, text_key
from postloom.session import store


def look_up(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Left join in which null keys match null keys."""
    side = side.withColumnRenamed(key, "side_key")
    return rows.join(side, F.col(key).eqNullSafe(F.col("side_key")), "left").drop("side_key")


def _topic_columns(topics: DataFrame) -> DataFrame:
    return topics.select(F.col("id").alias("topic_id"), "genre_id", "introduction")


def enriched(rows: DataFrame, posts: DataFrame, topics: DataFrame) -> DataFrame:
    """Interactions with topic, text, genre and introduction, and one 0/1 column per label."""
    posts = posts.select(F.col("id").alias("content_id"), F.col("subject_id").alias("topic_id"), "desc")
    joined = look_up(look_up(rows, posts, "content_id"), _topic_columns(topics), "topic_id")
    return joined.selectExpr("*", *one_hot())


def post_table(posts: DataFrame) -> DataFrame:
    """content_id, topic_id, desc_key and the cleaned desc of the posts; stored.

    The posts are read and their texts hashed once. What only needs the keys reads two or three
    columns of the stored table.
    """
    columns = posts.select(
        F.col("id").alias("content_id"), F.col("subject_id").alias("topic_id"),
        text_key(F.col("desc")).alias("desc_key"), clean(F.col("desc")).alias("desc"),
    )
    return store(columns, "posts")


def with_post(rows: DataFrame, post_table: DataFrame) -> DataFrame:
    """Interactions with topic id, one 0/1 column per label, and the 32-byte `desc_key` of the text.

    Repeats can be merged on the key; shuffling the full text of a post with each interaction would
    move far more bytes than the interactions themselves.
    """
    return look_up(rows, post_table.drop("desc"), "content_id").selectExpr("*", *one_hot())


def topic_copies(rows: DataFrame, topics: DataFrame) -> DataFrame:
    """Add `copies`: how many rows the join with the topics makes of a row."""
    copies = topics.groupBy(F.col("id").alias("topic_id")).agg(F.count("*").alias("copies"))
    return look_up(rows, copies, "topic_id").withColumn("copies", F.coalesce("copies", F.lit(1).cast("long")))


def with_topic(rows: DataFrame, topics: DataFrame) -> DataFrame:
    """Add genre and introduction; a topic that is there several times gives as many rows."""
    return look_up(rows, _topic_columns(topics), "topic_id")


def with_last_topic(rows: DataFrame, topics: DataFrame) -> DataFrame:
    """Add genre and introduction; of a topic that is there several times the last, in their order."""
    last = _topic_columns(topics).groupBy("topic_id").agg(F.max(F.struct("genre_id", "introduction")).alias("last"))
    return look_up(rows, last.select("topic_id", "last.*"), "topic_id")


def with_text(rows: DataFrame, post_table: DataFrame) -> DataFrame:
    """Bring the cleaned text back in place of `desc_key`. `rows` is a stored table.

    Only texts that occur are moved. Semi join, deduplication and join have the same keys, so they
    share one shuffle of the texts.
    """
    keys = ["content_id", "desc_key"]
    occurring = rows.where(F.col("desc_key").isNotNull()).select(*keys).distinct()
    texts = post_table.select(*keys, "desc").join(occurring, keys, "left_semi").dropDuplicates(keys)
    return rows.join(texts, keys, "left").drop("desc_key")
