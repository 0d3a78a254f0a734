"""Properties of the plans that keep them usable at scale."""

import re
import sys

import pytest

import __spark_entry__ as contract
from postloom import fixtures
from postloom.functions.labels import labelled
from postloom.operators.topics import content_raw, with_topic
from postloom.plans import interactions
from postloom.session import store

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["content", "inter_list", "user_content_list", "neg_sample", "repeat_merge", "interactions", "split_train"]
)
def test_no_python_and_no_single_task_on_rows(spark, name):
    plan = plan_of(contract.queries()[name](spark, FOLDER))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # The only exchange to one partition may come from a global aggregate: one row per task.
    assert not re.search(r"Window[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)


def test_topics_are_broadcast_and_posts_not_shuffled(spark):
    posts, topics = fixtures.posts(spark, FOLDER), store(fixtures.topics(spark, FOLDER), "topics")
    for df in (with_topic(posts, topics), content_raw(posts, topics)):
        plan = plan_of(df)
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_big_topics_are_not_broadcast(spark):
    posts, topics = fixtures.posts(spark, FOLDER), store(fixtures.topics(spark, FOLDER), "topics")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "SortMergeJoin" in plan_of(content_raw(posts, topics))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_json_is_parsed_once(spark):
    log = store(fixtures.user_action(spark, FOLDER), "log")
    assert plan_of(labelled(log, "drop")).count("from_json") == 1


def test_positive_codes_reach_the_scan(spark):
    log = store(fixtures.user_action(spark, FOLDER), "log")
    df = labelled(log.where(interactions.is_positive()), "drop")
    assert "PushedFilters: [In(event_id" in df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_text_stays_out_of_the_repeat_merge(spark):
    engaged = interactions.stored_engagements(fixtures.user_action(spark, FOLDER))
    posts = store(fixtures.posts(spark, FOLDER), "posts")
    df = interactions.ordered_interactions(engaged, posts, fixtures.topics(spark, FOLDER))
    for line in plan_of(df).splitlines():
        if "Exchange hashpartitioning(user_id" in line or "SortAggregate(key=[user_id" in line:
            assert "desc#" not in line


@pytest.fixture
def stored_plans(spark, monkeypatch):
    """Without broadcasts: the plan of every table that is stored, by label."""
    from postloom import session

    plans = {}

    def spied(df, label):
        plans.setdefault(label, []).append(plan_of(df))
        return original(df, label)

    original = session.store
    for name, module in list(sys.modules.items()):
        if name.startswith("postloom") and getattr(module, "store", None) is original:
            monkeypatch.setattr(module, "store", spied)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield plans
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_interactions_without_broadcast(spark, stored_plans):
    """Posts are scanned and hashed once; texts move once; topics stay out of the merge."""
    posts, topics = fixtures.posts(spark, FOLDER), fixtures.topics(spark, FOLDER)
    engaged = interactions.stored_engagements(fixtures.user_action(spark, FOLDER))
    final = plan_of(interactions.ordered_interactions(engaged, posts, topics))
    plans = [p for label in stored_plans for p in stored_plans[label]]
    assert sum(p.count("sha2") for p in [*plans, final]) == 1
    assert sum("documents.parquet" in line for p in [*plans, final] for line in p.splitlines()) == 1
    keyed = stored_plans["keyed-interactions"][0]
    assert "desc#" not in keyed
    for line in keyed.splitlines():
        if "Aggregate(key=[user_id" in line or "Exchange hashpartitioning(user_id" in line:
            assert "introduction" not in line
    # One shuffle for semi join, deduplication and join of the texts.
    assert sum("FileScan" in line and "desc#" in line for line in final.splitlines()) == 1
    assert final.count("Exchange hashpartitioning(content_id") == 3


def test_repeat_merge_reads_its_input_once(spark, stored_plans):
    contract.queries()["repeat_merge"](spark, FOLDER)
    assert len(stored_plans["enriched"]) == 1


def test_splits_are_few_passes_with_skipping(spark, stored_plans):
    from postloom.registry import _Inputs
    from postloom.operators.splits import Splits

    rows, lists = _Inputs(spark, FOLDER).rows_and_lists()
    splits = Splits(rows)
    plan = plan_of(splits.parts())
    assert plan.count("FileScan") == 1 + ("UNION" in plan.upper())
    text = splits.train(1)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "block" in text.split("PushedFilters")[1].split("]")[0]


def test_moments_are_hash_aggregates(spark):
    """No aggregate over the log or the engagements sorts its rows."""
    from postloom.functions.labels import labelled
    from postloom.operators.enrich import post_table, topic_copies, with_post
    from postloom.operators.repeats import engagements, last_per_text
    from postloom.operators.sampling import positives

    log = fixtures.user_action(spark, FOLDER)
    engaged = interactions.stored_engagements(log)
    table = post_table(fixtures.posts(spark, FOLDER))
    merged = last_per_text(topic_copies(with_post(positives(engaged), table), fixtures.topics(spark, FOLDER)))
    for df in (engagements(labelled(log, "drop")), interactions.first_engagements(engaged), merged):
        assert "SortAggregate" not in plan_of(df) and "HashAggregate" in plan_of(df)
