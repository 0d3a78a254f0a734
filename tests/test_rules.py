"""Semantic rules on small hand-made frames, against plain Python."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from postloom.functions.labels import EVENT_LABELS, MERGED_FLAGS, is_positive, label, labelled, one_hot, with_content_id
from postloom.functions.text import clean, known, text_key, to_long, to_long_or_zero
from postloom.operators.enrich import enriched, post_table, topic_copies, with_last_topic, with_post, with_text, with_topic
from postloom.operators.lists import list_pieces, ordered_lists
from postloom.operators.ordering import running_totals
from postloom.operators.repeats import engagements, last_per_text, merge_flags
from postloom.operators.sampling import capped_log, cohort_log, negative_quotas, pos_neg_ratio, sample_negatives
from postloom.operators.topics import content_raw, topic_counters
from postloom.plans.content import content, content_with_author, inter_list, post_users
from postloom.plans.interactions import user_content_list
from postloom.plans.users import user_dim
from postloom.session import store

LOG = "id long, user_id long, event_id int, event_data string, created_at long"
ENGAGED = (
    "user_id long, content_id long, follow string, first_at long, first_id long, created_at long, id long"
)

JSON_CASES = [
    ('{"content_id": 12}', 12, False),
    ('{"content_id": " 12 "}', 12, False),
    ('{"content_id": "12.5"}', 0, False),
    ('{"content_id": 12.9}', 12, False),
    ('{"content_id": -12.9}', -12, False),
    ('{"content_id": 1e3}', 1000, False),
    ('{"content_id": true}', 1, False),
    ('{"content_id": ""}', 0, False),
    ('{"content_id": "n/a"}', 0, False),
    ('{"content_id": "1_000"}', 1000, False),
    ('{"content_id": "+7"}', 7, False),
    ('{"content_id": "_7"}', 0, False),
    ('{"content_id": NaN}', 0, False),
    ('{"content_id": 9007199254740993}', 9007199254740993, False),
    ('{"content_id": 1, "content_id": 2}', 2, False),
    ('  {"content_id": 7}', 7, False),
    ('{"x": 1}', None, False),
    ("{}", None, False),
    ('{"a": {"content_id": 5}}', None, False),
    ("[1,2]", 0, False),
    ('[{"content_id": 3}]', 0, False),
    ("5", 0, False),
    ('"abc"', 0, False),
    ("null", 0, False),
    ('{"content_id": null}', None, True),
    ('{"content_id": [1]}', None, True),
    ('{"content_id": {"a": 1}}', None, True),
    ('{"content_id": 12', None, True),
    ("{'content_id': 3}", None, True),
    ("bad", None, True),
    (None, None, True),
]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_content_id_of_each_payload(spark):
    df = spark.createDataFrame([(i, 1, 254, c[0], i) for i, c in enumerate(JSON_CASES)], LOG)
    got = {r["id"]: (r["content_id"], r["bad_json"]) for r in with_content_id(df).collect()}
    assert got == {i: c[1:] for i, c in enumerate(JSON_CASES)}
    ids = labelled(df, "zero").select("id", "content_id").collect()
    assert {r[0]: r[1] for r in ids} == {i: c[1] or 0 for i, c in enumerate(JSON_CASES) if not c[2]}
    dropped = labelled(df, "drop").select("id").collect()
    assert {r[0] for r in dropped} == {i for i, c in enumerate(JSON_CASES) if c[1] is not None}


@pytest.mark.parametrize("payload", [c[0] for c in JSON_CASES if c[2]][:4])
def test_strict_raises_on_unusable_payload(spark, payload):
    df = spark.createDataFrame([(1, 1, 254, payload, 1)], LOG)
    with pytest.raises(PySparkException):
        with_content_id(df, strict=True).select("content_id").collect()
    usable = spark.createDataFrame([(1, 1, 254, "{}", 1)], LOG)
    assert with_content_id(usable, strict=True).select("content_id").collect()[0][0] is None


@pytest.mark.parametrize("payload", ['{"content_id": 5}junk', '{"content_id": 5} {"x": 1}', '{"content_id": 5}, {"a": 1}', '{"a": {"b": 1}}}'])
def test_strict_raises_on_text_after_the_object(spark, payload):
    df = spark.createDataFrame([(1, 1, 254, payload, 1)], LOG)
    assert with_content_id(df).select("content_id").collect()[0][0] in (5, None)
    with pytest.raises(PySparkException):
        with_content_id(df, strict=True).select("content_id").collect()


@pytest.mark.parametrize("payload", ['{"content_id": 5, "a": {"b": "}"}} ', '{"content_id": 5, "a": "{"}', "[1]", '{"content_id": 5}'])
def test_strict_takes_whole_objects(spark, payload):
    df = spark.createDataFrame([(1, 1, 254, payload, 1)], LOG)
    assert with_content_id(df, strict=True).select("content_id").collect()[0][0] in (5, 0)


def test_labels_and_flags(spark):
    codes = [c for group in EVENT_LABELS.values() for c in group] + [100, 221, None]
    df = spark.createDataFrame([(c,) for c in codes], "event_id int").withColumn("follow", label())
    for row in df.select("*", is_positive().alias("positive"), *[F.expr(e) for e in one_hot()]).collect():
        want = next((name for name, group in EVENT_LABELS.items() if row["event_id"] in group), "neg")
        assert row["follow"] == want
        assert bool(row["positive"]) == (want != "neg")
        assert [f for f in (*MERGED_FLAGS, "neg") if row[f]] == [want]


def test_incomplete_rows_are_dropped(spark):
    ok = '{"content_id": 1}'
    rows = [(1, 1, 254, ok, 5), (2, None, 254, ok, 5), (3, 1, None, ok, 5), (4, 1, 254, ok, None), (5, 1, 254, "{}", 5)]
    df = spark.createDataFrame(rows, LOG)
    assert [r["id"] for r in labelled(df, "drop").collect()] == [1]
    with pytest.raises(ValueError):
        labelled(df, "other")


def test_text(spark):
    df = spark.createDataFrame([("a b\r\n\tc　d ",), (None,), ("",), ("NA",), ("nan",), ("x",)], "t string")
    got = df.select(clean(F.col("t")), known(F.col("t")), text_key(F.col("t")).isNull()).collect()
    assert [tuple(r) for r in got] == [
        ("ab\tc　d", "a b\r\n\tc　d ", False), (None, None, True), ("", None, False),
        ("NA", None, False), ("nan", None, False), ("x", "x", False),
    ]


def test_numbers(spark):
    cases = {"12": 12, " 12": 12, "12.9": 12, "-12.9": -12, "123.0": 123, "1e3": 1000, "9007199254740993": 9007199254740993, None: None}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", to_long(F.col("t"))).collect()} == cases
    assert {r[0]: r[1] for r in df.select("t", to_long_or_zero(F.col("t"))).collect()} == cases | {None: 0}
    with pytest.raises(PySparkException):
        spark.createDataFrame([("abc",)], "t string").select(to_long(F.col("t"))).collect()


def test_user_without_a_column(spark):
    df = spark.createDataFrame([("1", None), (None, "3.9")], "id string, zan_count string")
    assert rows_of(user_dim(df)) == [(0, 0, 3), (1, 0, 0)]


POSTS = (
    "id long, user_id long, subject_id long, title string, desc string, praise_count long, reply_count long, "
    "forward_count long, star_count long, share_count long, create_time long"
)
TOPICS = "id long, title string, introduction string, genre_id long, create_time long"


def post(i, topic, praise=1, desc="text"):
    return (i, 9, topic, f"t {i}", desc, praise, 2, None, 0, 0, 5)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_topic_counters(spark, threshold):
    """Null topic, dangling topic, repeated topic, null counts; by broadcast and by sort-merge join."""
    posts = spark.createDataFrame(
        [post(1, 1), post(2, 1, None), post(3, 2), post(4, 2, 5), post(5, None), post(6, None), post(7, 8), post(8, 3, None)],
        POSTS,
    )
    topics = spark.createDataFrame(
        [(1, "a b", "in\ntro", 0, None), (2, "x", None, 1, 7), (2, "y", None, 1, 8), (3, "z", "i", 1, 9), (None, "none", "n", 0, 1)],
        TOPICS,
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        counters = {r[0]: tuple(r)[1:] for r in topic_counters(posts, topics).collect()}
        raw = content_raw(posts, topics).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Topic 2 is there twice, so each of its posts counts twice.
    assert counters == {1: (1, 4, 0), 2: (12, 8, 0), 3: (0, 2, 0), 8: (1, 2, 0), None: (0, 0, 0)}
    assert sorted((r["content_id"], r["topic_title"], r["topic_create_time"], r["topic_praise_count"]) for r in raw if r["topic_title"]) == [
        (1, "ab", 0, 1), (2, "ab", 0, 1), (3, "x", 7, 12), (3, "y", 8, 12), (4, "x", 7, 12), (4, "y", 8, 12),
        (5, "none", 1, 0), (6, "none", 1, 0), (8, "z", 9, 0),
    ]
    assert [r["content_id"] for r in raw if r["topic_title"] is None] == [7]
    assert {r["introduction"] for r in raw if r["content_id"] == 1} == {"intro"}


def test_content_with_lists_and_author(spark):
    posts = spark.createDataFrame([post(1, None), post(2, None), post(0, None)], POSTS)
    raw = content_raw(posts, spark.createDataFrame([], TOPICS))
    pairs = spark.createDataFrame([(1, 6), (1, 5), (0, 7), (3, 8)], "content_id long, user_id long")
    got = content_with_author(content(raw, pairs), posts)
    assert rows_of(got.select("content_id", "inter_list", "user_id", "author_user_id")) == [
        (0, None, 9, 9), (1, "5,6", 9, 9), (2, None, 9, 9),
    ]


def test_cap_is_strict_and_counts_incomplete_rows(spark):
    ok = '{"content_id": 1}'
    log = [(i, 1, 254, ok, i) for i in range(3)] + [(9, 2, 254, ok, 1), (10, 2, None, ok, 1), (11, None, 254, ok, 1)]
    df = spark.createDataFrame(log, LOG)
    assert {r["user_id"] for r in capped_log(df, 3).collect()} == {2}
    assert {r["user_id"] for r in capped_log(df, 2).collect()} == set()
    assert capped_log(df, 4).count() == 4
    assert cohort_log(df, 1, 4).select("user_id").distinct().count() == 1
    with pytest.raises(ValueError):
        cohort_log(df, 3, 4, strict=True)


def test_engagement_moments_break_ties_by_id(spark):
    ok = '{"content_id": 1}'
    df = spark.createDataFrame([(3, 1, 254, ok, 7), (9, 1, 248, ok, 7), (2, 1, 254, ok, 8), (1, 1, 254, ok, 8)], LOG)
    assert rows_of(engagements(labelled(df, "drop"))) == [(1, 1, "thumb", 7, 3, 8, 2)]


def random_items(seed, keys=5, n=300):
    rng = random.Random(seed)
    # One key holds a third of all rows.
    return sorted({(0 if rng.random() < 0.33 else rng.randrange(keys), rng.randrange(20), rng.randrange(10**6)) for _ in range(n)})


@pytest.mark.parametrize("seed", range(3))
def test_ordered_lists(spark, seed):
    items = random_items(seed)
    df = store(spark.createDataFrame(items, "k long, at long, item long").repartition(7), "items")
    want = []
    for k in sorted({i[0] for i in items}):
        entries = [str(i[2]) for i in sorted(items) if i[0] == k]
        want.append((k, ",".join(entries), len(entries)))
    assert sorted(tuple(r) for r in ordered_lists(df, "k", ["at"], "item").collect()) == want
    pieces = {}
    for r in sorted(list_pieces(df, "k", ["at"], "item").collect(), key=lambda r: (r["k"], r["part"])):
        pieces.setdefault(r["k"], []).append(r["list"])
    assert [(k, ",".join(p)) for k, p in sorted(pieces.items())] == [w[:2] for w in want]


@pytest.mark.parametrize("partitions", ["1", "4", "32"])
def test_running_totals(spark, partitions):
    items = random_items(3)
    df = spark.createDataFrame(items, "k long, at long, item long").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = running_totals(df, ["k", "at", "item"], {"n": "1", "total": "CASE WHEN k > 1 THEN item ELSE 0 END"}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    total, want = 0, []
    for n, (k, at, item) in enumerate(sorted(items)):
        want.append((k, at, item, n, total))
        total += item if k > 1 else 0
    assert sorted(tuple(r) for r in got) == want


def test_lists_from_the_log(spark):
    def event(i, user, content_id, at, code=254):
        return (i, user, code, f'{{"content_id": {content_id}}}', at)

    log = spark.createDataFrame(
        [event(1, 12, 5, 3), event(2, 12, 4, 3), event(3, 12, 5, 1, 262), event(4, 3, 5, 9), event(5, 3, 6, 1, 100),
         (6, 3, 254, "[1]", 10), (7, 12, 254, "{}", 0)],
        LOG,
    )
    assert rows_of(user_content_list(log)) == [(12, "5,4", 2), (3, "5,0", 2)]
    assert rows_of(inter_list(post_users(log))) == [(0, "3,12"), (4, "12"), (5, "3,12")]


def negatives_of(sizes, positives):
    rows = [(u, c, "neg", 1, 1, c, u * 1000 + c) for u, n in sizes.items() for c in range(n)]
    return rows + [(99, c, "thumb", 1, 1, c, c) for c in range(positives)]


def test_quota_is_half_to_even(spark):
    engaged = spark.createDataFrame(negatives_of({1: 1, 2: 3, 3: 5, 4: 1}, 5), ENGAGED)
    assert pos_neg_ratio(engaged).first()["ratio"] == 0.5
    assert rows_of(negative_quotas(engaged)) == [(1, 1, 0), (2, 3, 2), (3, 5, 2), (4, 1, 0)]


@pytest.mark.parametrize("seed", [0, 1])
def test_negative_sample(spark, seed):
    sizes = {1: 90, 2: 31, 3: 17, 4: 1}
    engaged = store(spark.createDataFrame(negatives_of(sizes, 60), ENGAGED).repartition(6), "engaged")
    light = rows_of(sample_negatives(engaged, seed))
    assert light == rows_of(sample_negatives(engaged, seed, rows_per_piece=2)) == rows_of(sample_negatives(engaged, seed, rows_per_piece=20))
    drawn = {u: sum(r[0] == u for r in light) for u in sizes}
    assert drawn == {u: round(n * (60 / 139)) for u, n in sizes.items()}
    assert light != rows_of(sample_negatives(engaged, seed + 1))


def test_negative_sample_limits(spark):
    short = store(spark.createDataFrame(negatives_of({1: 2}, 6), ENGAGED), "engaged")
    assert sample_negatives(short).count() == 2
    with pytest.raises(PySparkException):
        sample_negatives(short, strict=True).collect()
    none = store(spark.createDataFrame(negatives_of({}, 6), ENGAGED), "engaged")
    with pytest.raises(PySparkException):
        pos_neg_ratio(none).collect()


ENRICHED_TAIL = ", ".join(f"{f} int" for f in (*MERGED_FLAGS, "neg"))
ENRICHED = (
    "user_id long, content_id long, follow string, created_at long, id long, topic_id long, desc string, "
    f"genre_id long, introduction string, {ENRICHED_TAIL}"
)


def random_enriched(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        follow = rng.choice((*MERGED_FLAGS, "neg"))
        flags = [int(follow == f) for f in (*MERGED_FLAGS, "neg")]
        desc = rng.choice([None, "a", "b", "c d", "c\nd"])
        rows.append((rng.randrange(12), rng.randrange(30), follow, rng.randrange(6), i, rng.choice([None, 1, 2]), desc, rng.choice([None, 3]), rng.choice([None, "x"]), *flags))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_repeat_merge_against_loops(spark, seed):
    rows = random_enriched(seed)
    df = spark.createDataFrame(rows, ENRICHED)
    flags_at = slice(9, 13)
    want = []
    for r in rows:
        same = [o for o in rows if o[2] != "neg" and o[0] == r[0] and o[6] == r[6]]
        rep = r[2] != "neg" and len(same) > 1
        flags = list(r[flags_at])
        if rep:
            # A comparison with a missing text holds for no row.
            equal = [o for o in rows if o[0] == r[0] and r[6] is not None and o[6] == r[6]]
            flags = [min(sum(o[9 + i] for o in equal), 1) for i in range(4)]
        want.append((*r[:9], *flags, r[13], rep))
    assert rows_of(merge_flags(df)) == sorted(want, key=repr)

    last = {}
    for r in sorted((w for w in want if w[2] != "neg"), key=lambda w: (w[3], w[4])):
        last[r[0], r[6]] = r
    keyed = df.where("follow <> 'neg'").withColumn("desc_key", text_key(F.col("desc"))).withColumn("copies", F.lit(1).cast("long"))
    got = last_per_text(keyed).select("user_id", "content_id", "created_at", "id", "topic_id", *MERGED_FLAGS, "neg")
    assert rows_of(got) == sorted(((r[0], r[1], r[3], r[4], r[5], *r[flags_at], 0) for r in last.values()), key=repr)


def test_lookups_by_key_and_by_text_agree(spark):
    posts = spark.createDataFrame([post(1, 1, desc="a b"), post(2, None, desc=None), post(3, 7, desc="a b"), post(3, 1, desc="other")], POSTS)
    topics = spark.createDataFrame([(1, "t", "i", 4, 0), (None, "n", "null topic", 5, 0)], TOPICS)
    rows = spark.createDataFrame([(1, c, "thumb", c, c) for c in (1, 2, 3, 4)], "user_id long, content_id long, follow string, created_at long, id long")
    whole = enriched(rows, posts, topics).withColumn("desc", clean(F.col("desc")))
    # Post 3 is there twice, so its row is too; a row without a post has a null topic.
    assert whole.count() == 5
    assert {r["introduction"] for r in whole.where("content_id IN (2, 4)").collect()} == {"null topic"}
    table = post_table(posts)
    keyed = with_text(store(with_topic(with_post(rows, table), topics), "keyed"), table)
    assert rows_of(keyed.select(*whole.columns)) == rows_of(whole)


def test_repeats_count_the_copies_that_topics_make(spark):
    """A topic that is there twice makes its post a repeat of itself; the last of its rows stays."""
    posts = spark.createDataFrame([post(1, 1, desc=None), post(2, 2, desc=None)], POSTS)
    topics = spark.createDataFrame([(1, "t", "i", 4, 0), (1, "t", "k", 4, 0), (2, "t", None, None, 0)], TOPICS)
    rows = spark.createDataFrame([(1, 1, "thumb", 5, 1), (2, 2, "thumb", 5, 2)], "user_id long, content_id long, follow string, created_at long, id long")
    table = post_table(posts)
    merged = with_last_topic(last_per_text(topic_copies(with_post(rows, table), topics)), topics)
    got = rows_of(merged.select("user_id", "thumb", "genre_id", "introduction"))
    assert got == [(1, 0, 4, "k"), (2, 1, None, None)]
    # The same from whole rows.
    flagged = merge_flags(store(enriched(rows, posts, topics), "enriched"))
    assert rows_of(flagged.select("user_id", "thumb", "introduction")) == [(1, 0, "i"), (1, 0, "k"), (2, 1, None)]


def test_moments_order_as_pairs(spark):
    """Pairs of longs as one decimal: the same order, and the same pairs back."""
    from postloom.functions.moments import first_of, moment, second_of

    numbers = [None, -(2**63), -1, 0, 1, 2**63 - 1]
    epochs = [None, -5_399_999_999_999_999_999, -7, 0, 1_700_000_000, 1_700_000_000_000_000_000, 5_399_999_999_999_999_999]
    pairs = [(a, b) for a in epochs for b in numbers]
    df = spark.createDataFrame(pairs, "a long, b long").withColumn("m", moment(F.col("a"), F.col("b")))
    rows = df.select("a", "b", "m", first_of(F.col("m")).alias("x"), second_of(F.col("m")).alias("y")).collect()
    assert all((r["a"], r["b"]) == (r["x"], r["y"]) for r in rows)
    low = lambda v: -(2**70) if v is None else v
    by_pair = sorted(rows, key=lambda r: (low(r["a"]), low(r["b"])))
    assert by_pair == sorted(rows, key=lambda r: r["m"]) and len({r["m"] for r in rows}) == len(pairs)


def test_cohort_by_bins_is_the_cohort_by_order(spark):
    from postloom.operators.sampling import drawn_users, seeded

    events = spark.range(1_000).selectExpr("id * 7 AS user_id", "id % 20 AS events")
    for size in (0, 1, 37, 500, 949, 950, 2_000):
        want = events.where("events < 19").orderBy(seeded(3, "user_id"), "user_id").limit(size)
        for rows_per_piece in (10**6, 100, 3):
            got = drawn_users(events, size, 19, 3, rows_per_piece=rows_per_piece)
            assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect())
    with pytest.raises(ValueError):
        drawn_users(events, 951, 19, 3, strict=True)


def test_running_totals_of_equal_rows(spark):
    """Rows of one order value are spread over parts and each has a position of its own."""
    from postloom.operators import ordering

    rows = spark.range(3_000).selectExpr("if(id < 2500, 7, id % 5) AS x", "id AS v")
    placed = running_totals(rows, ["x"], {"place": "1"})
    found = placed.collect()
    assert placed.columns == ["x", "v", "place"] and sorted(r["place"] for r in found) == list(range(3_000))
    assert [r["x"] for r in sorted(found, key=lambda r: r["place"])] == sorted(r["x"] for r in found)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = ordering.range_parts(rows.selectExpr("*", "monotonically_increasing_id() AS t"), ["x", "t"])
        sizes = [r["count"] for r in parts.groupBy("part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 1_500
