"""The positional split against plain Python lists."""

import random

import pytest

from postloom.operators.splits import Splits, clustered
from postloom.session import store

ROWS = "block int, user_id long, created_at long, id long, content_num long, note string"


def reference_split(rows, k, order):
    key = {"reference": lambda r: (r[0], r[1], r[2], r[3]), "user": lambda r: (r[1], r[2], r[0], r[3])}[order]
    rows = sorted((r for r in rows if r[4] > k), key=key)
    a, d = int(len(rows) * 0.8), int(len(rows) * 0.1)
    train, dev, test = rows[:a], rows[a:a + d], rows[a + d:]
    train = [r for r in train if r[1] != train[-1][1]]
    dev = [r for r in dev if r[1] != dev[0][1]]
    test = {r[1] for r in test if r[1] != test[0][1]}
    return sorted(train, key=repr), sorted(dev, key=repr), sorted(test)


def rows_for(seed, users, n, positive_share, hot=0.0):
    rng = random.Random(seed)
    num = {u: rng.randrange(1, 8) for u in range(users)}
    rows = []
    for i in range(n):
        user = users // 2 if rng.random() < hot else rng.randrange(users)
        block = 0 if rng.random() < positive_share else 1
        rows.append((block, user, rng.randrange(50), i, num[user], rng.choice([None, "a", "b"])))
    return rows


CASES = {
    "mixed": rows_for(1, 30, 200, 0.5),
    "mostly positive": rows_for(2, 30, 200, 0.95),
    "one user with a third": rows_for(3, 20, 300, 0.5, hot=0.35),
    "a hot user across the cuts": rows_for(4, 3, 100, 0.4, hot=0.9),
    "one user": rows_for(5, 1, 20, 0.5),
    "few rows": rows_for(6, 3, 4, 0.5),
    "one row": rows_for(7, 1, 1, 1.0),
    "none": [],
    "cuts between users": [(0, u, i, 10 * u + i, 9, None) for u in range(10) for i in range(10)],
}


@pytest.mark.parametrize("order", ["reference", "user"])
@pytest.mark.parametrize("name", list(CASES))
def test_split(spark, name, order):
    rows = CASES[name]
    df = store(spark.createDataFrame(rows, ROWS).repartition(5), "rows")
    lists = spark.createDataFrame([(u, f"list {u}") for u in range(30)], "user_id long, content_list string")
    splits = Splits(df, order, tiers=(1, 3))
    parts = [(r["k"], r["part"], tuple(r)[:6]) for r in splits.parts().collect()]
    for k in (1, 3):
        train, dev, test = reference_split(rows, k, order)
        assert sorted((tuple(r) for r in splits.train(k).collect()), key=repr) == train
        assert sorted((tuple(r) for r in splits.dev(k).collect()), key=repr) == dev
        for part, rows_of_part in (("train", train), ("dev", dev)):
            assert sorted((r for t, p, r in parts if (t, p) == (k, part)), key=repr) == rows_of_part
        assert sorted(tuple(r) for r in splits.test(k, lists).collect()) == [(u, f"list {u}") for u in test]


@pytest.mark.parametrize("partitions", ["1", "4", "32"])
def test_split_under_any_number_of_partitions(spark, partitions):
    rows = CASES["one user with a third"]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        splits = Splits(store(clustered(spark.createDataFrame(rows, ROWS)), "rows"), tiers=(1,))
        train, dev, test = reference_split(rows, 1, "reference")
        assert sorted((tuple(r) for r in splits.train(1).collect()), key=repr) == train
        assert sorted((tuple(r) for r in splits.dev(1).collect()), key=repr) == dev
        assert sorted(r["user_id"] for r in splits.test_users().collect()) == test
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
