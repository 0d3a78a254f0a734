import math
import random
import re

import pytest
from pyspark.sql import functions as F

from postloom.llm import mixing
from postloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Shares by weight, limits at three times, the excess given to the others until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        target = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            return target | {s: 3 * sizes[s] for s in full}
        full |= above


def check(rows, docs, tolerance=0.02):
    """Every source's taken words are near its target; `rows` name their source by its size."""
    sizes = {}
    by_id = {}
    for d in docs:
        sizes[d["source"]] = sizes.get(d["source"], 0) + words(d["text"])
        by_id.setdefault((d["doc_id"], words(d["text"])), []).append(d["source"])
    assert len(rows) == len(docs)
    target = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        sources = by_id[r["doc_id"], r["size"]]
        source = next(s for s in sources if sizes[s] == r["source_size"])
        sources.remove(source)
        assert r["target"] == pytest.approx(target[source])
        taken[source] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    for s, t in taken.items():
        if t or target[s]:
            assert t == pytest.approx(target[s], rel=tolerance)


def plain_rate(sizes, target):
    """Bisection on the multiplier of one source: the rate of each size."""
    low, high = -1e5, 1e5
    rate = lambda m, n: min(3.0, math.exp(max(-700.0, min(50.0, m * n / max(sizes)))))
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(n * rate(middle, n) for n in sizes) < target else (low, middle)
    return {n: rate(low, n) for n in sizes}


def test_whole_table(shipped):
    docs = shipped.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = QUERIES["op3_source_mix"](shipped, FOLDER).collect()
    check(rows, docs, 0.005)
    again = QUERIES["op3_source_mix"](shipped, FOLDER).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_one_source_keeps_its_share(shipped):
    docs = shipped.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("source", F.lit("s"))
    rows = mixing.mix(docs).collect()
    assert {r["rate"] for r in rows} == {1.0}
    assert all(r["copies"] == 1 for r in rows)


def test_rates_are_exponential_in_size(shipped):
    """The rates of several sources against a plain solution of each; a log of an uncut rate is proportional to the size."""
    draw = random.Random(5)
    text = lambda n: " ".join(["w"] * n)
    rows = [(i, text(draw.randint(1, 60) if i % 4 else 200), "en", "abcde"[min(draw.randint(0, 9), 4)], 0) for i in range(600)]
    found = mixing.mix(shipped.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append(words(r[1]))
    target = plain_targets({s: sum(n) for s, n in by_source.items()})
    tilts = 0
    for s, sizes in by_source.items():
        expected = plain_rate(sizes, target[s])
        got = {r["size"]: r["rate"] for r in found if r["source_size"] == sum(sizes)}
        assert got == {n: pytest.approx(expected[n], rel=1e-6) for n in set(sizes)}
        uncut = {n: math.log(r) / n for n, r in got.items() if r < 3}
        assert not uncut or max(uncut.values()) == pytest.approx(min(uncut.values()), rel=1e-6)
        tilts += any(abs(x) > 1e-4 for x in uncut.values())
    assert tilts >= 2


@pytest.mark.parametrize(("ids", "texts"), [(lambda i: None, 1), (lambda i: i % 30, 50)], ids=["null", "thirty"])
def test_repeated_and_null_ids(documents, ids, texts):
    """1,000 documents of ten words in each of three sources: targets are met though ids and texts repeat."""
    docs = documents([(ids(i), f"{i % texts} two three four five six seven eight nine ten", "en", s) for s in "abc" for i in range(1_000)])
    rows = mixing.mix(docs).collect()
    taken = {}
    for r in rows:
        taken[r["target"]] = taken.get(r["target"], 0) + r["taken"]
    assert sorted(taken) == [3_750, 7_500, 18_750]
    assert all(abs(t - target) <= 10 for target, t in taken.items())
    copies = mixing.mixed(docs)
    assert copies.columns == docs.columns
    found = {r["source"]: r["count"] for r in copies.groupBy("source").count().collect()}
    assert found == {s: t // 10 for s, t in zip("abc", sorted(taken.values(), reverse=True))}


def test_limits_and_small_sources(documents):
    text = "one two three four five six seven eight nine ten"
    rows = [(i, text[: 4 * (i % 7 + 1)], "en", "a") for i in range(40)]
    rows += [(100 + i, " ".join([text] * (i % 5 + 1)), "en", "b") for i in range(200)]
    rows += [(500 + i, " ".join([text] * 3), "en", "c") for i in range(90)]
    found = mixing.mix(documents(rows)).collect()
    check(found, documents(rows).collect(), 0.03)
    # The first source is at its limit: every document three times.
    assert all(r["copies"] == 3 for r in found if r["doc_id"] < 40 and r["size"])


def test_odd_rows(odd_documents, empty_documents):
    rows = mixing.mix(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert mixing.mix(empty_documents).count() == 0
    repeated = mixing.mixed(odd_documents)
    assert repeated.columns == odd_documents.columns
    assert repeated.where("doc_id = 2").count() == 1
    assert mixing.mixed(empty_documents).count() == 0


def test_the_mix_repeats_documents_as_planned(shipped):
    docs = shipped.read.parquet(f"{FOLDER}/documents.parquet")
    planned = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
    counts = {r["doc_id"]: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()}
    assert counts == planned
