"""The content dimension: posts, topics, counters and the users of each post."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from postloom.functions.labels import is_positive, labelled
from postloom.operators.lists import list_pieces, ordered_lists


def post_users(capped_log: DataFrame, strict: bool = False, counts: Observation | None = None) -> DataFrame:
    """Each post with each user who engaged with it; rows without a post id count for id 0."""
    positive = capped_log.where(is_positive())
    return labelled(positive, missing="zero", strict=strict, counts=counts).select("content_id", "user_id").distinct()


def inter_list(pairs: DataFrame) -> DataFrame:
    """Per post the users who engaged with it, by ascending id, from `post_users`."""
    lists = ordered_lists(pairs, "content_id", ["user_id"], "user_id")
    return lists.select("content_id", F.col("list").alias("inter_list"))


def no_post_users(pairs: DataFrame) -> DataFrame:
    """The users of id 0, "no post": one row each, in order over range partitions, so in any number."""
    return pairs.where(F.col("content_id") == 0).select("user_id").repartitionByRange("user_id").sortWithinPartitions("user_id")


def inter_list_pieces(pairs: DataFrame) -> DataFrame:
    """The same lists in pieces, without a bound on the users of a post: content_id, part, inter_list, num."""
    return list_pieces(pairs, "content_id", ["user_id"], "user_id").withColumnRenamed("list", "inter_list")


def content(raw: DataFrame, pairs: DataFrame) -> DataFrame:
    """Content with its users, from `post_users`. Id 0 stands for "no post"; its list is not made."""
    known = inter_list(pairs.where(F.col("content_id") != 0))
    return raw.join(known, "content_id", "left").select(*raw.columns, "inter_list")


def content_with_author(content: DataFrame, posts: DataFrame) -> DataFrame:
    """Content with the author of the post as `author_user_id`."""
    authors = posts.select(F.col("id").alias("author_of"), F.col("user_id").alias("author_user_id"))
    joined = content.join(authors, F.col("content_id").eqNullSafe(F.col("author_of")), "left").drop("author_of")
    return joined.withColumn("topic_create_time", F.coalesce("topic_create_time", F.lit(0).cast("long")))
