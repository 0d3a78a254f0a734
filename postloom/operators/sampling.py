"""Activity cap, user cohorts and the stratified sample of negatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.operators.ordering import ROWS_PER_PIECE, pieces_per_key
from postloom.session import store

LOG_COLUMNS = ("user_id", "event_id", "event_data", "created_at")


def activity(log: DataFrame) -> DataFrame:
    """Events per known user."""
    return log.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count("*").alias("events"))


def _typed_log(log: DataFrame) -> DataFrame:
    return (
        log.na.drop("any", subset=list(LOG_COLUMNS))
        .select(*[F.col(c) if c == "event_data" else F.col(c).cast("long").alias(c) for c in ("id", *LOG_COLUMNS)])
    )


def capped_rows(log: DataFrame, events: DataFrame, cap: int = 10_000) -> DataFrame:
    """Complete log rows of users with fewer than `cap` events, by their stored `activity`.

    Only the few users at or over the cap are stored and taken out. While that table is under
    Spark's broadcast threshold the log itself is not shuffled; beyond it, the join is a
    sort-merge join, whose skewed partitions adaptive execution splits.
    """
    over = store(events.where(F.col("events") >= cap).select("user_id"), "over-cap")
    return _typed_log(log).join(over, "user_id", "left_anti")


def capped_log(log: DataFrame, cap: int = 10_000) -> DataFrame:
    return capped_rows(log, activity(log), cap)


def seeded(seed: int, *columns: str) -> Column:
    """A reproducible random order: a pure function of the row, so retries cannot change it."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def drawn_users(
    events: DataFrame, size: int = 5_000, cap: int = 10_000, seed: int = 0, strict: bool = False, rows_per_piece: int = ROWS_PER_PIECE
) -> DataFrame:
    """`size` users under the cap, drawn without replacement from a stored `activity`: those of the
    smallest seeded digests. `strict` raises if there are fewer.

    The users are counted by the leading digits of their digests, as many digits as bring a bin to
    about `rows_per_piece` users. All users of the bins before the one in which the cohort ends are
    in it; only that bin is put in order. So no task meets the cohort, of whatever size.
    """
    draw = events.where(F.col("events") < cap).select("user_id").withColumn("draw", seeded(seed, "user_id"))
    users = draw.count()
    if strict and users < size:
        raise ValueError(f"fewer than {size} users are under the cap of {cap} events")
    digits = 0
    while 16**digits * rows_per_piece < users:
        digits += 1
    if not digits:
        return store(draw.orderBy("draw", "user_id").limit(size).select("user_id"), "cohort")
    prefix = F.substring("draw", 1, digits)
    # One row per bin: some 16 for each `rows_per_piece` users at most.
    bins = draw.groupBy(prefix.alias("bin")).agg(F.count("*").alias("n"))
    ends = store(bins.withColumn("before", F.expr("sum(n) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")), "bins")
    last = ends.where((F.coalesce("before", F.lit(0)) < size) & (F.coalesce("before", F.lit(0)) + F.col("n") >= size)).first()
    # Stored, so that the users are drawn once and Spark knows how many they are.
    if last is None:  # fewer users than are wanted, or none wanted
        return store(draw.select("user_id") if size else draw.select("user_id").where("false"), "cohort")
    whole = draw.where(prefix < last["bin"]).select("user_id")
    rest = draw.where(prefix == last["bin"]).orderBy("draw", "user_id").limit(size - (last["before"] or 0)).select("user_id")
    return store(whole.unionByName(rest), "cohort")


def cohort_log(log: DataFrame, size: int = 5_000, cap: int = 10_000, seed: int = 0, strict: bool = False) -> DataFrame:
    """Complete log rows of a cohort."""
    users = drawn_users(store(activity(log), "activity"), size, cap, seed, strict)
    return _typed_log(log).join(users, "user_id", "left_semi")


def positives(engagements: DataFrame) -> DataFrame:
    return engagements.where(F.col("follow") != "neg")


def negatives(engagements: DataFrame) -> DataFrame:
    return engagements.where(F.col("follow") == "neg")


def pos_neg_ratio(engagements: DataFrame) -> DataFrame:
    """One row: positives, negatives and positives per negative. No negatives at all raises."""
    counts = engagements.agg(
        F.count_if(F.col("follow") != "neg").alias("positives"),
        F.count_if(F.col("follow") == "neg").alias("negatives"),
    )
    none = F.raise_error(F.lit("no negatives to sample from")).cast("double")
    return counts.withColumn(
        "ratio",
        F.when(F.col("negatives") == 0, none).otherwise(
            F.col("positives").cast("double") / F.col("negatives").cast("double")
        ),
    )


def _quota(count: Column, ratio: Column) -> Column:
    """Half-to-even, like the rounding the quotas were defined with."""
    return F.rint(count * ratio).cast("long")


def negative_quotas(engagements: DataFrame) -> DataFrame:
    """Per user: negatives there are, and negatives to draw."""
    ratio = pos_neg_ratio(engagements).select("ratio").scalar()
    return (
        negatives(engagements)
        .groupBy("user_id")
        .agg(F.count("*").alias("negatives"))
        .withColumn("quota", _quota(F.col("negatives"), ratio))
    )


def sample_negatives(
    engagements: DataFrame, seed: int = 0, strict: bool = False, rows_per_piece: int = ROWS_PER_PIECE
) -> DataFrame:
    """Per user the quota of negatives, in seeded order. `engagements` is a stored table.

    The rows of a user are cut into slices by the leading digits of the seeded order: as many digits
    as bring a slice to about `rows_per_piece` rows, none for nearly all users, so no task has to
    rank all rows of a user. Slice sizes tell which slices the quota reaches and how many rows it
    takes from each. A quota over the user's negatives takes them all; `strict` raises.
    """
    digest = seeded(seed, "user_id", "content_id")
    digits = pieces_per_key(negatives(engagements), "user_id", rows_per_piece).select(
        "user_id", F.ceil(F.log(16.0, F.col("pieces"))).cast("int").alias("digits")
    )
    rows = negatives(engagements).withColumn("draw", digest).join(digits, "user_id", "left")
    rows = rows.withColumn("slice", F.expr("substring(draw, 1, coalesce(digits, 0))")).drop("digits")
    ratio = pos_neg_ratio(engagements).select("ratio").scalar()
    of_user = Window.partitionBy("user_id")
    earlier = of_user.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice: about rows / rows_per_piece of them for a user.
    slices = (
        rows.groupBy("user_id", "slice")
        .agg(F.count("*").alias("n"))
        .withColumn("negatives", F.sum("n").over(of_user))
        .withColumn("quota", _quota(F.col("negatives"), ratio))
        .withColumn("left", F.col("quota") - F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    )
    if strict:
        over = F.raise_error(F.lit("a quota is larger than the user's negatives")).cast("long")
        slices = slices.withColumn("left", F.when(F.col("quota") > F.col("negatives"), over).otherwise(F.col("left")))
    reached = rows.join(
        slices.where(F.col("left") > 0).select("user_id", "slice", "n", "left"), ["user_id", "slice"]
    )
    in_slice = Window.partitionBy("user_id", "slice").orderBy("draw", "content_id")
    return (
        reached.withColumn("rank", F.row_number().over(in_slice))
        .where(F.col("rank") <= F.col("left"))
        .select(*engagements.columns)
    )


def short_of_negatives(engagements: DataFrame, sample: DataFrame) -> int:
    """How many users have fewer negatives than their quota, told from the sample: they gave all they
    have and the quota, a rounded share of it, is larger, which needs a ratio above 1."""
    ratio = pos_neg_ratio(engagements).select("ratio").first()[0]
    if ratio <= 1:
        return 0
    given = sample.groupBy("user_id").agg(F.count("*").alias("n"))
    return given.where(_quota(F.col("n"), F.lit(ratio)) > F.col("n")).count()
