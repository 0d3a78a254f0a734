"""Time the steps of the interactions job on a skewed log; prints one JSON line.

A third of the rows belongs to one user and a third to one post. SKEW_ROWS sets the size (10 million),
BENCH_CPUS the threads.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from postloom.operators.sampling import sample_negatives  # noqa: E402
from postloom.operators.splits import Splits  # noqa: E402
from postloom.plans import interactions  # noqa: E402
from postloom.plans.jobs import fan_out  # noqa: E402
from postloom.session import scratch, session, store  # noqa: E402


def skewed_log(spark: SparkSession, rows: int) -> DataFrame:
    return spark.range(rows).selectExpr(
        "id", f"CASE WHEN id % 3 = 0 THEN 7 ELSE xxhash64(id) & {max(rows // 100, 1)} END AS user_id",
        "CASE WHEN id % 5 < 2 THEN 254 ELSE 100 END AS event_id",
        f"""concat('{{"content_id": ', CASE WHEN id % 3 = 1 THEN 11 ELSE (xxhash64(id, 1) & {max(rows // 3, 1)}) + 1 END, '}}') AS event_data""",
        "1700000000 + id % 1000000 AS created_at",
    )


def skewed_posts(spark: SparkSession, rows: int) -> DataFrame:
    return spark.range(max(rows // 3, 1) + 2).selectExpr(
        "id", "id % 1000 AS user_id", "id % 100 AS subject_id", "concat('title ', id) AS title", "concat('a text of post ', id % 700000) AS desc",
        "1L AS praise_count", "1L AS reply_count", "1L AS forward_count", "1L AS star_count", "1L AS share_count", "id AS create_time",
    )


def main() -> None:
    rows, cpus = int(os.environ.get("SKEW_ROWS", "10000000")), os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.TemporaryDirectory(prefix="skew-")
    spark = session("skew", f"local[{cpus}]", **{"spark.checkpoint.dir": shared.name, "spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, make):
        start = time.perf_counter()
        found = make()
        times[name] = round(time.perf_counter() - start, 1)
        return found

    with scratch(spark):
        log, posts = store(skewed_log(spark, rows), "log"), store(skewed_posts(spark, rows), "posts")
        topics = store(spark.range(100).selectExpr("id", "'t' AS title", "'an introduction' AS introduction", "id % 5 AS genre_id", "id AS create_time"), "topics")
        engaged = timed("log to engagements", lambda: interactions.stored_engagements(log))
        lists = timed("lists per user", lambda: store(interactions.content_lists(engaged), "lists"))
        timed("negative sample", lambda: store(sample_negatives(engaged), "sample"))
        stored = timed("interactions", lambda: store(interactions.with_content_num(interactions.ordered_interactions(engaged, posts, topics), lists), "rows"))
        splits = timed("cut points", lambda: Splits(stored))
        out = f"{shared.name}/out"
        timed("interactions, tiers, train and dev in order", lambda: fan_out(splits, out))
        timed("test of all tiers", lambda: store(splits.tests(lists), "tests"))
        files = spark.read.parquet(f"{out}/content_with_topiccnt").groupBy(F.input_file_name()).count().select("count").collect()
        sizes = sorted(r[0] for r in files)
    parts = {"parts": len(sizes), "least": sizes[0], "median": sizes[len(sizes) // 2], "most": sizes[-1]}
    print(json.dumps({"metric": "skewed log, seconds per step", "rows": rows, "seconds": times, "rows_per_part": parts}))


if __name__ == "__main__":
    main()
