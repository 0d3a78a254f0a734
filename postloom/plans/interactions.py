"""From the raw log to labelled interactions, activity tiers and their splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from postloom.functions.labels import is_positive, labelled
from postloom.functions.moments import first_of, moment, second_of
from postloom.functions.text import clean
from postloom.operators.enrich import post_table, topic_copies, with_last_topic, with_post, with_text, with_topic
from postloom.operators.lists import list_pieces, ordered_lists
from postloom.operators.repeats import engagements, last_per_text
from postloom.operators.sampling import positives, sample_negatives
from postloom.operators.splits import TIERS
from postloom.schemas import INTERACTIONS, TIER
from postloom.session import store


def stored_engagements(log: DataFrame, strict: bool = False, counts: Observation | None = None) -> DataFrame:
    return store(engagements(labelled(log, missing="drop", strict=strict, counts=counts)), "engagements")


def first_engagements(engaged: DataFrame) -> DataFrame:
    """Each user with each post engaged, and when that first happened."""
    return (
        positives(engaged)
        .groupBy("user_id", "content_id")
        .agg(F.min(moment(F.col("first_at"), F.col("first_id"))).alias("first"))
        .select("user_id", "content_id", first_of(F.col("first")).alias("first_at"), second_of(F.col("first")).alias("first_id"))
    )


def content_lists(engaged: DataFrame) -> DataFrame:
    """Per user the distinct posts in order of first engagement, and how many."""
    lists = ordered_lists(first_engagements(engaged), "user_id", ["first_at", "first_id"], "content_id")
    return lists.select("user_id", F.col("list").alias("content_list"), F.col("num").alias("content_num"))


def content_list_pieces(engaged: DataFrame) -> DataFrame:
    """The same lists in pieces, without a bound on the posts of a user: user_id, part, content_list, num."""
    pieces = list_pieces(first_engagements(engaged), "user_id", ["first_at", "first_id"], "content_id")
    return pieces.withColumnRenamed("list", "content_list")


def piece_counts(pieces: DataFrame) -> DataFrame:
    """Per user how many posts its pieces hold: content_num."""
    return pieces.groupBy("user_id").agg(F.sum("num").alias("content_num"))


def user_content_list(log: DataFrame, strict: bool = False) -> DataFrame:
    """`content_lists` straight from the log; reads the rows of positive events only."""
    positive = labelled(log.where(is_positive()), missing="drop", strict=strict)
    return content_lists(engagements(positive))


def sampled_union(engaged: DataFrame, seed: int = 0, strict: bool = False) -> DataFrame:
    """All positives and the sampled negatives."""
    return positives(engaged).unionByName(sample_negatives(engaged, seed, strict))


def ordered_interactions(
    engaged: DataFrame, posts: DataFrame, topics: DataFrame, seed: int = 0, strict: bool = False, sample: DataFrame | None = None
) -> DataFrame:
    """Interactions with the columns that order them: block (0 positives, 1 negatives) and log id.

    The negatives are drawn unless a stored `sample` of them is given. Texts and introductions stay out of the merge of repeats: keys stand for texts, and topics are
    looked up afterwards.
    """
    table = post_table(posts)
    merged = last_per_text(topic_copies(with_post(positives(engaged), table), topics))
    merged = with_last_topic(merged, topics).withColumn("block", F.lit(0))
    drawn = sample_negatives(engaged, seed, strict) if sample is None else sample
    sampled = with_topic(with_post(drawn, table), topics)
    both = store(merged.unionByName(sampled.select(*[c for c in merged.columns if c != "block"], F.lit(1).alias("block"))), "keyed-interactions")
    zero = F.lit(0).cast("long")
    return with_text(both, table).select(
        *[
            F.coalesce(c, zero).alias(c) if c in ("topic_id", "genre_id")
            else clean(F.col(c)).alias(c) if c == "introduction"
            else F.col(c)
            for c in INTERACTIONS
        ],
        "block", "id", "content_id",
    )


def public(rows: DataFrame, contract: dict[str, str] = INTERACTIONS) -> DataFrame:
    return rows.select(*contract)


def interactions(engaged: DataFrame, posts: DataFrame, topics: DataFrame, seed: int = 0, strict: bool = False) -> DataFrame:
    """Labelled interactions: positives merged per text, and sampled negatives."""
    return public(ordered_interactions(engaged, posts, topics, seed, strict))


def with_content_num(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """Interactions with the number of posts of the user, all that tiers and splits need."""
    joined = rows.join(lists.select("user_id", "content_num"), "user_id", "left")
    return joined.withColumn("content_num", F.coalesce("content_num", F.lit(0).cast("long")))


def top_tier(tiers: tuple[int, ...] = TIERS) -> Column:
    """A row's highest tier, null without any."""
    return F.greatest(*[F.when(F.col("content_num") > k, k) for k in tiers], F.lit(None).cast("int"))


def with_top_tier(rows: DataFrame, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """The rows of any tier with `top`, their highest one: tier k is the rows with top >= k."""
    return rows.withColumn("top", top_tier(tiers)).where(F.col("top").isNotNull())


def wide_tiers(rows: DataFrame, lists: DataFrame, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """All tiers as single tables have them, with tier `k`: each interaction with the list of its user.

    The list repeats on each row of its user in each tier, so this form grows with the square of a
    user's posts. One pass over the rows and one join make all tiers.
    """
    each = F.explode(F.filter(F.array(*[F.lit(k) for k in tiers]), lambda k: F.col("content_num") > k))
    tiers_of = rows.withColumn("k", each).drop("content_num")
    return tiers_of.join(lists, "user_id", "left").select(*TIER, "k")
