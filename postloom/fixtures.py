"""The four app exports, derived from the generated test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def user_action(spark: SparkSession, folder: str) -> DataFrame:
    events = _table(spark, folder, "events")
    if isinstance(events.schema["ts"].dataType, T.TimestampNTZType):
        seconds = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01', ts)"
    else:
        seconds = "unix_seconds(ts)"
    return (
        events.selectExpr(
            "*",
            "bigint(regexp_extract(props, '[0-9]+', 0)) AS k",
            "event_type IN ('click', 'purchase') AND user_id % 10 <> 0 AS p",
        )
        .selectExpr(
            "*",
            """CASE WHEN k >= 95 THEN 9000000 + k
                    WHEN p AND user_id % 10 BETWEEN 1 AND 6 THEN k % (user_id % 10) + 100 * (user_id % 3)
                    ELSE k + 100 * (user_id % 3) END AS cid""",
        )
        .selectExpr(
            "event_id AS id",
            "user_id",
            """CASE WHEN p AND event_type = 'click' THEN array(254, 248, 257, 249, 258)[int(event_id % 5)]
                    WHEN p THEN array(256, 262, 263, 264, 310)[int(event_id % 5)]
                    WHEN event_id % 41 <> 0 THEN 100 END AS event_id""",
            """CASE WHEN event_id % 101 = 0 THEN '[1,2]'
                    WHEN event_id % 23 = 1 THEN '{"x": 1}'
                    WHEN event_id % 101 = 2 THEN '{"content_id": "n/a"}'
                    WHEN event_id % 101 = 4 THEN concat('{"content_id": ', cid)
                    WHEN event_id % 101 = 6 THEN '{"content_id": null}'
                    WHEN event_id % 101 = 8 THEN '{"content_id": [1, 2]}'
                    WHEN event_id % 23 = 3 THEN concat('{"content_id": "', cid, '"}')
                    ELSE concat('{"content_id": ', cid, '}') END AS event_data""",
            f"{seconds} AS created_at",
        )
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").selectExpr(
        "doc_id AS id",
        "doc_id % 150 AS user_id",
        "CASE WHEN doc_id % 29 <> 28 THEN doc_id % 28 END AS subject_id",
        "substr(text, 1, 40) AS title",
        "CASE WHEN doc_id % 17 <> 5 THEN text END AS desc",
        "n_chars % 50 AS praise_count",
        "n_chars % 7 AS reply_count",
        "n_chars % 11 AS forward_count",
        "n_chars % 5 AS star_count",
        "n_chars % 3 AS share_count",
        "1700000000 + doc_id AS create_time",
    )


def topics(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = _table(spark, folder, "nation"), _table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "bigint(n_nationkey) AS id",
        "n_name AS title",
        "concat(n_name, ' in ', chr(10), r_name) AS introduction",
        "bigint(n_regionkey) AS genre_id",
        "CASE WHEN n_nationkey % 6 <> 5 THEN bigint(1600000000 + n_nationkey) END AS create_time",
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "customer").selectExpr(
        "string(c_custkey) AS id",
        "CASE WHEN c_custkey % 7 <> 6 THEN string(c_nationkey % 3) END AS sex",
        "CASE WHEN c_custkey % 11 <> 10 THEN string(c_acctbal) END AS zan_count",
    )
