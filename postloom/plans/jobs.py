"""The batch jobs: exports in, products out. Each returns its row counts.

A job runs inside `scratch`, so its intermediate tables are gone when it ends. What a job reads more
than once is read from a product it has written, or from an intermediate Parquet table.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postloom.operators import sampling, topics
from postloom.operators.splits import TIERS, Splits
from postloom.plans import content, interactions, users
from postloom.schemas import CAPPED_LOG, INTERACTIONS
from postloom.session import delete, exists, move, scratch, store
from postloom.sources import exports
from postloom.sources.products import replace_product, write_product


def _is_csv(path: str) -> bool:
    return path.rstrip("/").endswith(".csv")


def read_input(spark: SparkSession, kind: str, path: str, multiline: bool = True, lenient: bool = False) -> tuple[DataFrame, Observation | None]:
    """An export, and the counts of its lines if lenient: a CSV path ends in .csv, all else is Parquet
    with the same columns. Lines with too many fields raise; `lenient` leaves them out of posts and
    topics."""
    if not _is_csv(path):
        return spark.read.parquet(path), None
    if kind in ("posts", "topics"):
        read = exports.read_posts if kind == "posts" else exports.read_topics
        counts = Observation(kind) if lenient else None
        return read(spark, path, not lenient, multiline, counts), counts
    read = exports.read_user_action if kind == "log" else exports.read_users
    return read(spark, path, multiline), None


def ingest(spark: SparkSession, kind: str, path: str, multiline: bool = True, lenient: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """An input as a Parquet table, and its counts: a CSV export is read once and stored."""
    table, counts = read_input(spark, kind, path, multiline, lenient)
    if not _is_csv(path):
        return table, {}
    table = store(table, kind)
    return table, {f"{kind}_{name}": value for name, value in counts.get.items()} if counts else {}


def _product(df: DataFrame, path: str, form: str, label: str) -> DataFrame:
    """Write a product and return it for further use: read back, or for texts from a stored table."""
    if form == "parquet":
        write_product(df, path, form)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    stored = store(df, label)
    write_product(stored, path, form)
    return stored


def user_job(user_table: DataFrame, out: str, form: str = "parquet") -> dict[str, int]:
    return {"users": _product(users.user_dim(user_table), f"{out}/user", form, "user").count()}


def activity_job(
    log: DataFrame, out: str, form: str = "parquet", cap: int = 10_000, size: int = 5_000, seed: int = 0
) -> dict[str, int]:
    """The log without hyper-active users, and the same for a random cohort.

    The log is scanned twice, for the activity and for the rows; the cohort reads the capped log.
    """
    with scratch(log.sparkSession):
        events = store(sampling.activity(log), "activity")
        capped = _product(sampling.capped_rows(log, events, cap).select(*CAPPED_LOG), f"{out}/useract_all", form, "capped")
        drawn = sampling.drawn_users(events, size, cap, seed, strict=True)
        cohort = _product(capped.join(drawn, "user_id", "left_semi").select(*CAPPED_LOG), f"{out}/useract5k", form, "cohort")
        over = events.agg(F.count("*").alias("users"), F.count_if(F.col("events") >= cap).alias("over"), F.sum("events").alias("rows")).first()
        return {
            "log_rows_with_user": over["rows"] or 0, "users": over["users"], "users_over_cap": over["over"],
            "useract_all": capped.count(), "useract5k": cohort.count(),
        }


def content_job(
    log: DataFrame, posts: DataFrame, topic_table: DataFrame, out: str, form: str = "parquet",
    cap: int = 10_000, strict: bool = True, pieces: bool = False,
) -> dict[str, int]:
    """Content with topic counters and users, from the capped log; once more with the author.

    `strict` raises on unusable payloads; otherwise they are counted and left out. `pieces` writes
    the users of posts in pieces, without a bound on their number, in place of whole lists and of the
    products that hold whole lists.
    """
    with scratch(log.sparkSession):
        counts = Observation("log")
        raw = _product(topics.content_raw(posts, topic_table), f"{out}/content_raw", form, "content-raw")
        events = store(sampling.activity(log), "activity")
        capped = sampling.capped_rows(log, events, cap)
        pairs = store(content.post_users(capped, strict, counts), "post-users")
        found = {"positive_rows": counts.get["log_rows"], "bad_json": counts.get["bad_json"], "content_raw": raw.count()}
        if pieces:
            lists = _product(content.inter_list_pieces(pairs), f"{out}/inter_list_pieces", form, "pieces")
            return found | {"inter_list_pieces": lists.count()}
        # The users of "no post" may be nearly all there are: rows in order, not a cell.
        without_post = _product(content.no_post_users(pairs), f"{out}/inter_list_no_post", form, "no-post")
        lists = _product(content.inter_list(pairs.where("content_id <> 0")), f"{out}/inter_list", form, "inter-list")
        whole = _product(content.content(raw, pairs), f"{out}/content", form, "content")
        author_job(whole, posts, f"{out}/content_with_author", form)
        return found | {"inter_list": lists.count(), "inter_list_no_post": without_post.count(), "content": whole.count()}


def author_job(content_table: DataFrame, posts: DataFrame, path: str, form: str = "parquet") -> None:
    """Rewrite the content with the author of each post; a product that is at `path` is replaced at once."""
    replace_product(content.content_with_author(content_table, posts), path, form)


# The products of one fan-out, and the columns that become their folders.
_FANNED = {"content_with_topiccnt": (), "bt": ("top",), "splits": ("k", "part")}


def fan_out(splits: Splits, out: str, form: str = "parquet") -> None:
    """All interactions, their tiers and the parts of their splits, in one pass and one shuffle.

    Rows are range-partitioned once, each with the names of the folders it goes to. The bounds run
    through users, so files follow the order and no user, however active, makes one file large. What
    is written goes to its places by renames at the end, so a job that fails leaves no product behind.
    """
    spark, staged = splits.rows.sparkSession, f"{out}/_fan-out-{uuid4().hex}"
    for product in _FANNED:
        if exists(spark, f"{out}/{product}"):
            raise FileExistsError(f"{out}/{product} is already there")
    place = "struct({} AS product, {} AS k, {} AS part)"
    every = F.expr("array(" + place.format("'content_with_topiccnt'", "0", "'all'") + ")")
    top = F.array(F.struct(F.lit("bt").alias("product"), interactions.top_tier(splits.tiers).alias("k"), F.lit("all").alias("part")))
    parts = F.transform("places", lambda p: F.struct(F.lit("splits").alias("product"), p["k"].alias("k"), p["part"].alias("part")))
    of_row = F.filter(F.concat(every, top), lambda p: p["k"].isNotNull())
    places = F.concat(F.when(F.col("whole"), of_row).otherwise(F.array().cast("array<struct<product: string, k: int, part: string>>")), parts)
    order = [*splits.by, *splits.inside]
    rows = splits.placed().withColumn("places", places).drop("whole").repartitionByRange(*order)
    each = rows.select(*dict.fromkeys([*INTERACTIONS, *order]), F.inline("places"))
    folders = ["product", "k", "part"]
    write_product(each.sortWithinPartitions(*folders, *order).select(*INTERACTIONS, *folders), staged, form, folders)
    for tier in splits.tiers:
        if exists(spark, f"{staged}/product=bt/k={tier}"):
            move(spark, f"{staged}/product=bt/k={tier}/part=all", f"{out}/bt/top={tier}")
    if exists(spark, f"{staged}/product=splits"):
        move(spark, f"{staged}/product=splits", f"{out}/splits")
    if exists(spark, f"{staged}/product=content_with_topiccnt"):
        move(spark, f"{staged}/product=content_with_topiccnt/k=0/part=all", f"{out}/content_with_topiccnt")
    delete(spark, staged)
    for product, named in _FANNED.items():
        if not exists(spark, f"{out}/{product}"):  # without a row
            empty = interactions.public(splits.rows).where("false").select("*", *[F.lit("").alias(c) for c in named])
            write_product(empty, f"{out}/{product}", form, named)


def interactions_job(
    log: DataFrame, posts: DataFrame, topic_table: DataFrame, out: str, form: str = "parquet", seed: int = 0,
    strict: bool = False, strict_quotas: bool = False, order: str = "reference", tiers: tuple[int, ...] = TIERS, wide: bool = False,
    pieces: bool = False,
) -> dict[str, int]:
    """Lists per user, labelled interactions, activity tiers and their splits.

    The raw log is read once, into the engagements; interactions and lists are computed once and stored.
    Interactions, tiers and splits are written in one pass (`fan_out`): `bt` has a folder per highest
    tier (`top`), `splits` and `test` one per tier (`k`). Rows are sorted inside each file, and files
    follow the order. `wide` adds `bt_wide`, tiers with lists. `pieces` writes the lists of users and the
    ground truth in pieces, without a bound on the posts of a user, and makes no whole list.
    """
    if wide and pieces:
        raise ValueError("wide tiers hold whole lists")
    with scratch(log.sparkSession):
        counts = Observation("log")
        engaged = interactions.stored_engagements(log, strict, counts)
        if pieces:
            lists = _product(interactions.content_list_pieces(engaged), f"{out}/content_with_interlist_pieces", form, "content-lists")
            nums = store(interactions.piece_counts(lists), "content-nums")
        else:
            nums = lists = _product(interactions.content_lists(engaged), f"{out}/content_with_interlist", form, "content-lists")
        sample = store(sampling.sample_negatives(engaged, seed, strict_quotas), "negatives")
        ordered = interactions.ordered_interactions(engaged, posts, topic_table, seed, strict_quotas, sample)
        rows = store(interactions.with_content_num(ordered, nums), "interactions")
        splits = Splits(rows, order, tiers)
        fan_out(splits, out, form)
        if pieces:
            write_product(splits.test_pieces(lists), f"{out}/test_pieces", form, ["k"])
        else:
            write_product(splits.tests(lists).select("user_id", "content_list", "k"), f"{out}/test", form, ["k"])
        if wide:
            write_product(interactions.wide_tiers(rows, lists, tiers), f"{out}/bt_wide", form, ["k"])
        totals = rows.agg(F.count("*").alias("n"), *[F.count_if(F.col("content_num") > k).alias(f"bt{k}") for k in tiers]).first().asDict()
        return counts.get | {
            "engagements": engaged.count(), "interactions": totals.pop("n"), "users_short_of_negatives": sampling.short_of_negatives(engaged, sample),
        } | totals
