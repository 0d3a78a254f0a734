"""The registered queries: each operator and product on the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postloom import fixtures
from postloom.functions.labels import FLAGS, label, labelled, with_content_id
from postloom.operators import enrich, repeats, sampling, topics
from postloom.operators.splits import Splits, clustered
from postloom.plans import content, interactions, jobs, users
from postloom.schemas import CAPPED_LOG, INTERACTIONS, POSTS, PRODUCTS, USER_ACTION, USERS
from postloom.session import shared_folder, store
from postloom.sources import exports, products

# The test log has at most 99 events per user, so the cap and the cohort are small here.
CAP, COHORT = 70, 40
ENGAGEMENT = ("user_id", "content_id", "follow", "created_at", "id")


class _Inputs:
    """The four exports under one folder, and the tables most queries start from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def log(self) -> DataFrame:
        return fixtures.user_action(self.spark, self.folder)

    @cached_property
    def posts(self) -> DataFrame:
        return fixtures.posts(self.spark, self.folder)

    @cached_property
    def topics(self) -> DataFrame:
        return fixtures.topics(self.spark, self.folder)

    @cached_property
    def users(self) -> DataFrame:
        return fixtures.users(self.spark, self.folder)

    def engaged(self) -> DataFrame:
        return interactions.stored_engagements(self.log)

    def capped(self) -> DataFrame:
        return sampling.capped_log(self.log, CAP)

    def content_raw(self) -> DataFrame:
        return topics.content_raw(self.posts, self.topics)

    def post_users(self) -> DataFrame:
        return store(content.post_users(self.capped()), "post-users")

    def content(self) -> DataFrame:
        return content.content(self.content_raw(), self.post_users())

    def enriched(self) -> DataFrame:
        union = interactions.sampled_union(self.engaged()).select(*ENGAGEMENT)
        return enrich.enriched(union, self.posts, self.topics)

    def merged(self) -> DataFrame:
        return repeats.merge_flags(store(self.enriched(), "enriched"))

    def rows_and_lists(self) -> tuple[DataFrame, DataFrame]:
        """The interactions with `content_num`, and the list of each user; both stored."""
        engaged = self.engaged()
        lists = store(interactions.content_lists(engaged), "content-lists")
        rows = interactions.ordered_interactions(engaged, self.posts, self.topics)
        return store(clustered(interactions.with_content_num(rows, lists)), "interactions"), lists


def _inter_list_pieces(i: _Inputs) -> DataFrame:
    """The pieces of each list strung together, and the sum of their entries."""
    pieces = content.inter_list_pieces(i.post_users())
    whole = pieces.groupBy("content_id").agg(
        F.sort_array(F.collect_list(F.struct("part", "inter_list"))).alias("pieces"), F.sum("num").alias("num")
    )
    return whole.select("content_id", F.array_join(F.transform("pieces", lambda p: p["inter_list"]), ",").alias("inter_list"), "num")


def _label_distribution(i: _Inputs) -> DataFrame:
    return i.log.groupBy(label().alias("follow")).agg(F.count("*").alias("events"))


def _payload_counts(i: _Inputs) -> DataFrame:
    rows = with_content_id(i.log)
    return rows.agg(F.count("*").alias("log_rows"), F.count_if("bad_json").alias("bad_json"))


def _content_id_counts(i: _Inputs) -> DataFrame:
    rows = labelled(i.log, missing="zero")
    return rows.groupBy("content_id").agg(F.count("*").alias("events"))


def _bt_tiers(i: _Inputs) -> DataFrame:
    return interactions.wide_tiers(*i.rows_and_lists())


def _part(i: _Inputs, part: str) -> DataFrame:
    parts = Splits(i.rows_and_lists()[0]).parts().where(F.col("part") == part)
    return parts.select(*INTERACTIONS, "k")


def _split_test(i: _Inputs) -> DataFrame:
    rows, lists = i.rows_and_lists()
    return Splits(rows).tests(lists)


def _split_user_order(i: _Inputs) -> DataFrame:
    """Train and dev; the rows of test users with the list in place of the text."""
    rows, lists = i.rows_and_lists()
    splits = Splits(rows, order="user")
    tests = splits.tests(lists).select(
        "user_id",
        *[F.lit(None).cast(kind).alias(c) if c != "desc" else F.col("content_list").alias(c) for c, kind in INTERACTIONS.items() if c != "user_id"],
        "k", F.lit("test").alias("part"),
    )
    return splits.parts().select(*INTERACTIONS, "k", "part").unionByName(tests)


def _preview(i: _Inputs) -> DataFrame:
    rows = interactions.ordered_interactions(i.engaged(), i.posts, i.topics)
    return interactions.public(products.preview(rows, ["block", "user_id", "created_at", "id"]))


def _folder(i: _Inputs, label: str) -> str:
    return f"{shared_folder(i.spark)}/{label}-{uuid4().hex}"


def _tsv(product: str, make: Callable[[_Inputs], DataFrame], strict: bool = True, form: str = "lines") -> Callable[[_Inputs], DataFrame]:
    """A product written as text and read back by its contract."""
    read = products.read_tsv if form == "tsv" else products.read_lines

    def query(i: _Inputs) -> DataFrame:
        path = _folder(i, product)
        products.write_product(make(i).select(*PRODUCTS[product]), path, form)
        return read(i.spark, path, product, strict)

    return query


def _cell(name: str, kind: str) -> Column:
    text = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')) if kind == "string" else text


def _write_csv(rows: DataFrame, columns: list[str], path: str, line: Column | None = None) -> None:
    """Rows as CSV files, each with its header, as many as `rows` has parts; `line` in place of the plain line."""
    kinds = dict(rows.dtypes)
    plain = F.concat_ws(",", *[_cell(c, kinds[c]) for c in columns])
    header = ",".join(columns) + "\n"
    # Each file starts with the header line: the low 33 bits count the rows of a partition.
    first = F.monotonically_increasing_id().bitwiseAND(2**33 - 1) == 0
    lines = rows.select((plain if line is None else line).alias("value"))
    lines.select(F.when(first, F.concat(F.lit(header), "value")).otherwise(F.col("value"))).write.mode("append").text(path)


def _two_headers(rows: DataFrame, columns: list[str], path: str) -> None:
    """A folder of files of two makes: their columns stand in opposite order."""
    _write_csv(rows.where("id % 2 = 0"), columns, path)
    _write_csv(rows.where("id % 2 = 1"), ["other", *columns[::-1]], path)


def _log_csv(i: _Inputs) -> DataFrame:
    path = _folder(i, "log")
    _two_headers(i.log.withColumn("other", F.lit("x, y")), list(USER_ACTION), path)
    return exports.read_user_action(i.spark, path)


def _user_csv(i: _Inputs) -> DataFrame:
    path = _folder(i, "users")
    _two_headers(i.users.withColumn("other", F.lit(1)), list(USERS), path)
    return exports.read_users(i.spark, path)


def _user_without_sex(i: _Inputs) -> DataFrame:
    path = _folder(i, "users")
    _write_csv(i.users, ["zan_count", "id"], path)
    return users.user_dim(exports.read_users(i.spark, path))


def _strict_csv(i: _Inputs) -> DataFrame:
    path = _folder(i, "posts")
    _two_headers(i.posts.withColumn("other", F.lit(1)), list(POSTS), path)
    return exports.read_posts(i.spark, path, strict=True)


def _lenient_csv(i: _Inputs) -> DataFrame:
    """The posts as a CSV export with faults: lines with one and two fields too many, the last one
    empty, and lines cut off after the title."""
    cells = [_cell(c, kind if kind == "string" else "bigint") for c, kind in POSTS.items()]
    whole = F.concat_ws(",", *cells)
    line = (
        F.when(F.col("id") % 5 == 2, F.concat_ws(",", cells[0], cells[1], F.lit(""), cells[list(POSTS).index("title")]))
        .when(F.col("id") % 5 == 1, F.concat(whole, F.lit(",extra")))
        .when(F.col("id") % 5 == 4, F.concat(whole, F.lit(",extra,")))
        .otherwise(whole)
    )
    path = _folder(i, "posts")
    _write_csv(i.posts, list(POSTS), path, line)
    return exports.read_posts(i.spark, path)


def _left_out(i: _Inputs) -> DataFrame:
    """How many lines of that export there are, and how many a lenient scan leaves out."""
    counts = Observation("posts")
    cells = F.concat_ws(",", *[_cell(c, kind if kind == "string" else "bigint") for c, kind in POSTS.items()])
    path = _folder(i, "posts")
    _write_csv(i.posts, list(POSTS), path, F.when(F.col("id") % 5 == 1, F.concat(cells, F.lit(",extra"))).otherwise(cells))
    store(exports.read_posts(i.spark, path, counts=counts), "posts")
    return i.spark.createDataFrame([(counts.get["lines"], counts.get["lines_left_out"])], "lines long, lines_left_out long")


def _fan_out(i: _Inputs, product: str) -> DataFrame:
    """Interactions, tiers and splits written in one pass; one of these read back."""
    out = _folder(i, "fan-out")
    jobs.fan_out(Splits(i.rows_and_lists()[0]), out)
    return i.spark.read.parquet(f"{out}/{product}")


def _strung(pieces: DataFrame, keys: list[str], text: str) -> DataFrame:
    """The pieces of each list strung together, and the sum of their entries."""
    whole = pieces.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("part", text))).alias("pieces"), F.sum("num").alias("content_num"))
    return whole.select(*keys, F.when(F.size("pieces") > 0, F.array_join(F.transform("pieces", lambda p: p[text]), ",")).alias(text), "content_num")


def _user_list_pieces(i: _Inputs) -> DataFrame:
    return _strung(interactions.content_list_pieces(i.engaged()), ["user_id"], "content_list")


def _split_test_pieces(i: _Inputs) -> DataFrame:
    engaged = i.engaged()
    pieces = store(interactions.content_list_pieces(engaged), "pieces")
    rows = interactions.ordered_interactions(engaged, i.posts, i.topics)
    rows = store(interactions.with_content_num(rows, interactions.piece_counts(pieces)), "interactions")
    return _strung(Splits(rows).test_pieces(pieces), ["k", "user_id"], "content_list")


def _content_rewrite(i: _Inputs) -> DataFrame:
    """Content as a product, rewritten with its author to a new path, twice: the second replaces the first."""
    whole, path = _folder(i, "content"), _folder(i, "rewritten")
    products.write_product(i.content().select(*PRODUCTS["content"]), whole)
    for _ in range(2):
        jobs.author_job(i.spark.read.parquet(whole), i.posts, path)
    return i.spark.read.parquet(path)


_QUERIES: dict[str, Callable[[_Inputs], DataFrame]] = {
    "label_distribution": _label_distribution,
    "payload_counts": _payload_counts,
    "content_id_counts": _content_id_counts,
    "user_dim": lambda i: users.user_dim(i.users),
    "activity": lambda i: sampling.activity(i.log),
    "capped_log": lambda i: i.capped().select(*CAPPED_LOG),
    "cohort_log": lambda i: sampling.cohort_log(i.log, COHORT, CAP).select(*CAPPED_LOG),
    "post_topic": lambda i: topics.with_topic(i.posts, i.topics),
    "topic_counters": lambda i: topics.topic_counters(i.posts, i.topics),
    "content_raw": lambda i: i.content_raw(),
    "inter_list": lambda i: content.inter_list(i.post_users()),
    "inter_list_pieces": _inter_list_pieces,
    "content": lambda i: i.content(),
    "no_post_users": lambda i: content.no_post_users(i.post_users()),
    "content_rewrite": _content_rewrite,
    "content_author": lambda i: content.content_with_author(i.content(), i.posts),
    "user_content_list": lambda i: interactions.user_content_list(i.log),
    "user_list_pieces": _user_list_pieces,
    "pos_dedupe": lambda i: sampling.positives(repeats.engagements(labelled(i.log, "drop"))).select(*ENGAGEMENT),
    "neg_dedupe": lambda i: sampling.negatives(repeats.engagements(labelled(i.log, "drop"))).select(*ENGAGEMENT),
    "pos_neg_ratio": lambda i: sampling.pos_neg_ratio(repeats.engagements(labelled(i.log, "drop"))),
    "neg_quota": lambda i: sampling.negative_quotas(i.engaged()),
    "neg_sample": lambda i: sampling.sample_negatives(i.engaged()).select(*ENGAGEMENT),
    "sampled_union": lambda i: interactions.sampled_union(i.engaged()).select(*ENGAGEMENT),
    "enriched": lambda i: i.enriched(),
    "repeat_flags": lambda i: i.merged().select("user_id", "content_id", "follow", "rep"),
    "repeat_merge": lambda i: i.merged().select("user_id", "content_id", "follow", "rep", *FLAGS),
    "interactions": lambda i: interactions.interactions(i.engaged(), i.posts, i.topics),
    "bt_tiers": _bt_tiers,
    "split_train": lambda i: _part(i, "train"),
    "split_dev": lambda i: _part(i, "dev"),
    "split_test": _split_test,
    "split_test_pieces": _split_test_pieces,
    "split_user_order": _split_user_order,
    "preview": _preview,
    "tsv_roundtrip": _tsv("content_raw", lambda i: i.content_raw(), strict=False),
    "tsv_log": _tsv("useract_all", lambda i: i.capped()),
    "tsv_user": _tsv("user", lambda i: users.user_dim(i.users)),
    "tsv_inter_list": _tsv("inter_list", lambda i: content.inter_list(i.post_users())),
    "tsv_content": _tsv("content", lambda i: i.content(), strict=False),
    "tsv_content_author": _tsv("content_with_author", lambda i: content.content_with_author(i.content(), i.posts), strict=False),
    "tsv_user_lists": _tsv("content_with_interlist", lambda i: interactions.user_content_list(i.log)),
    "tsv_interactions": _tsv("content_with_topiccnt", lambda i: interactions.interactions(i.engaged(), i.posts, i.topics)),
    "tsv_tier": _tsv("bt", _bt_tiers, form="packed"),
    "tsv_test": _tsv("test", _split_test),
    "tsv_quoted": _tsv("content_raw", lambda i: i.content_raw(), strict=False, form="tsv"),
    "fan_out_rows": lambda i: _fan_out(i, "content_with_topiccnt"),
    "fan_out_tiers": lambda i: _fan_out(i, "bt"),
    "fan_out_splits": lambda i: _fan_out(i, "splits"),
    "log_csv": _log_csv,
    "user_csv": _user_csv,
    "user_without_sex": _user_without_sex,
    "strict_csv": _strict_csv,
    "lenient_csv": _lenient_csv,
    "left_out_lines": _left_out,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def on_tables(make: Callable[[_Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: make(_Inputs(spark, folder))

    return {name: on_tables(make) for name, make in _QUERIES.items()}
