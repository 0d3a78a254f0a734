"""CSV records over files that are split anywhere."""

import csv
import io
import random

import pytest

from postloom.sources import exports
from postloom.sources.records import INSIDE, OUTSIDE, records, state_after


@pytest.mark.parametrize(
    ("line", "outside", "inside"),
    [
        ("a,b", OUTSIDE, INSIDE), ("", OUTSIDE, INSIDE), ('"a,b"', OUTSIDE, OUTSIDE), ('a,"b', INSIDE, OUTSIDE), ('b",c', OUTSIDE, OUTSIDE),
        ('5" tv,"x', INSIDE, INSIDE), ('"a""b",c', OUTSIDE, OUTSIDE), ('"a""', INSIDE, OUTSIDE), ('""', OUTSIDE, INSIDE), ('"', INSIDE, OUTSIDE),
        ('x","y', INSIDE, INSIDE), ('a, "b', OUTSIDE, OUTSIDE), ('"a"b,"c', INSIDE, INSIDE),
    ],
)
def test_states(line, outside, inside):
    assert (state_after(line, OUTSIDE), state_after(line, INSIDE)) == (outside, inside)


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def cells(draw):
    words = ["a", "line", "two\nlines", 'say "x"', "c, d", "", "long " * 30 + "\n\n" + "more " * 20, '"', "\n", "e\r\nf"]
    return [str(draw.randrange(1000)), draw.choice(words), draw.choice(words)]


def test_records_cross_blocks(spark, tmp_path, small_blocks):
    """Cells with line breaks, longer than blocks, in files of two line ends: the records a CSV reader finds."""
    draw = random.Random(4)
    want = []
    for number, end in enumerate(["\n", "\r\n", "\n"]):
        rows = [cells(draw) for _ in range(60)]
        text = io.StringIO()
        csv.writer(text, lineterminator=end).writerows([["id", "sex\nor not", "zan_count"], *rows])
        body = ("\n\n" if number == 2 else "") + text.getvalue() + ("" if number else "\n \n")
        (tmp_path / f"{number}.csv").write_bytes(body.encode())
        want += [[c.replace("\r\n", "\n") for c in row] for row in rows]
    found = records(spark, [str(tmp_path / f"{n}.csv") for n in range(3)])
    got = [next(csv.reader(io.StringIO(r["record"], newline=""))) for r in found.collect()]
    assert sorted(got) == sorted(want)


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    path = tmp_path / "users.csv"
    path.write_text("id,sex,zan_count\n" + "".join(f'{i},"1\n",{2 * i}\n' for i in range(100)), encoding="utf-8")
    rows = exports.read_users(spark, str(path)).collect()
    assert sorted((int(r["id"]), r["sex"], int(r["zan_count"])) for r in rows) == [(i, "1\n", 2 * i) for i in range(100)]
    blocks = spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions()
    assert blocks > 8


def test_an_open_quote_takes_the_rest_of_its_file(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text('id,sex,zan_count\n1,"x,2\n3,4,5\n' + "6,7,8\n" * 40, encoding="utf-8")
    (tmp_path / "b.csv").write_text("id,sex,zan_count\n9,1,2\n", encoding="utf-8")
    found = sorted(r["record"] for r in records(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")]).collect())
    assert found == ['1,"x,2\n3,4,5\n' + "6,7,8\n" * 39 + "6,7,8", "9,1,2"]
