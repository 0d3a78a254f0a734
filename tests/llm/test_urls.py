import math
import random
import re
import time
import zlib

import pyarrow as pa
import pytest

from postloom.llm import urls
from postloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return host.translate(LOWER), re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def plain_rule(host, path):
    fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


@pytest.fixture(scope="module")
def odd_pages(shipped):
    given = [
        "https://WWW.Example.COM/en/1", "http://example.com/en/", "http://a.b.example.com/en/x?y#z", "http://x.com", "http://x.com?q=/a",
        "http://com/", "ftp://xcom/", "http://n.net/es/1", "http://net/fr/", "no scheme", "", None, "://", "a://b://c/d", "http://h\n.com/p\nq?r",
        "http://ÄB.com/É", "http://x.org/" + "y" * 20_000, "http://x.org/1", "http://x.org/1",
    ]
    rows = [(i, u, "<p>x</p>") for i, u in enumerate(given)] + [(None, "http://x.org/1", None)]
    frame = shipped.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("host", "path", "rule", "verdict", "score", "all", "held"):
        frame = frame.withColumn(name, frame["html"])
    return frame


def check(rows, given):
    assert sorted((r["page_id"] is None, r["page_id"] or 0) for r in rows) == sorted((i is None, i or 0) for i, _ in given)
    by_id = dict(given)
    for r in rows:
        host, path = plain_split(by_id[r["page_id"]])
        rule, verdict = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("allow" if r["score"] >= 0 else "block"))


def test_whole_table_follows_the_rules(shipped):
    pages = shipped.read.parquet(f"{FOLDER}/pages.parquet").collect()
    check(QUERIES["op6_url_filter"](shipped, FOLDER).collect(), [(p["page_id"], p["url"]) for p in pages])


def test_odd_rows(odd_pages):
    check(urls.filter_urls(odd_pages).collect(), [(p["page_id"], p["url"]) for p in odd_pages.collect()])
    assert urls.filter_urls(odd_pages.where("false")).count() == 0


def test_likelihoods_add_up_and_equal_a_plain_count():
    counts = {"": {"a": 3, "b": 1}, "a": {"a": 2, "b": 1}}
    model = urls.CharacterModel(counts)
    base = 1 / urls.ALPHABET

    def chance(context, char):
        p = base
        for c in ["", *([context] if context and context in counts else [])]:
            n, t = sum(counts[c].values()), len(counts[c])
            p = (t * p + n * counts[c].get(char, 0) / n) / (n + t)
        return p

    expected = math.log(chance("", "a")) + math.log(chance("a", "b")) + math.log(chance("b", "\x03"))
    assert model.log_likelihood("ab") == pytest.approx(expected)


def test_held_out_rule_urls_are_told_apart(shipped):
    """Trained on rule-labelled pages, judged on those of another table."""
    def labelled(folder):
        pages = shipped.read.parquet(f"{folder}/pages.parquet").select("url")
        host, path = urls.split_url(pages["url"])
        pages = pages.withColumns({"host": host, "path": path})
        rule, verdict = urls.rule_of(pages["host"], pages["path"])
        return pages.select("url", verdict.alias("verdict"))

    model = urls.learn(labelled("/root/testdata/sf0.1"))
    rows = [r for r in labelled("/root/testdata/sf0.001").collect() if r["verdict"]]
    right = sum((model.difference(r["url"]) >= model.threshold) == (r["verdict"] == "allow") for r in rows)
    assert right >= 0.9 * len(rows)


def test_contexts_are_counted_in_stretches(monkeypatch):
    monkeypatch.setattr(urls, "_HELD", 50)
    monkeypatch.setattr(urls, "_STRETCH", 7)
    given = [("allow", "http://a.com/xyz/xyz"), ("block", ""), ("allow", "é" * 40), ("block", "http://a.com/xyz/xyz")]
    batch = pa.RecordBatch.from_pylist([{"verdict": v, "url": u} for v, u in given])
    found = {}
    for part in urls._contexts(iter([batch])):
        for r in part.to_pylist():
            found[r["verdict"], r["context"], r["char"]] = found.get((r["verdict"], r["context"], r["char"]), 0) + r["n"]
    plain = {}
    for verdict, url in given:
        marked = f"\x02{url}\x03"
        for at in range(1, len(marked)):
            for n in range(min(5, at) + 1):
                key = verdict, marked[at - n : at], marked[at]
                plain[key] = plain.get(key, 0) + 1
    assert found == plain


def test_models_and_verdicts_equal_a_plain_count(shipped):
    """Witten-Bell models counted in plain Python over all rule-decided URLs, and the verdicts they give."""
    pages = shipped.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = urls.filter_urls(pages).collect()
    url_of = {p["page_id"]: p["url"] for p in pages.collect()}
    given = sorted({(p["url"], plain_rule(*plain_split(p["url"]))[1]) for p in pages.collect()})
    after = {"allow": {}, "block": {}}
    for url, verdict in given:
        if verdict and zlib.crc32(url.encode()) % 4:
            marked = f"\x02{url}\x03"
            for at in range(1, len(marked)):
                for n in range(min(5, at) + 1):
                    follow = after[verdict].setdefault(marked[at - n : at], {})
                    follow[marked[at]] = follow.get(marked[at], 0) + 1

    def likelihood(verdict, url):
        total, marked = 0.0, f"\x02{url}\x03"
        for at in range(1, len(marked)):
            p = 1 / 1_114_112
            for n in range(min(5, at) + 1):
                follow = after[verdict].get(marked[at - n : at], {})
                seen, kinds = sum(follow.values()), len(follow)
                if seen < 2 and n:
                    break
                p = (kinds * p + follow.get(marked[at], 0)) / (seen + kinds)
            total += math.log(p)
        return total

    difference = {u: (likelihood("allow", u) - likelihood("block", u)) / (len(u) + 1) for u, _ in given}
    held = [(difference[u], v == "allow") for u, v in given if v and zlib.crc32(u.encode()) % 4 == 0]
    assert 0 < len(held) < urls.SAMPLED_URLS
    threshold = urls.calibrate(held)
    for r in found:
        if r["rule"] is None:
            assert r["score"] == pytest.approx(difference[url_of[r["page_id"]]] - threshold, abs=1e-9)


def test_long_urls_take_time_in_proportion(shipped):
    long = [(1, f"http://a.com/{'ab1/' * 250_000}"), (2, f"http://b.net/es/{'xyz' * 300_000}"), *[(i, f"http://c{i}.com/x") for i in range(3, 40)], *[(i, f"http://d{i}.net/fr/") for i in range(40, 80)]]
    start = time.perf_counter()
    rows = urls.filter_urls(shipped.createDataFrame(long, "page_id long, url string")).collect()
    assert time.perf_counter() - start < 40 and len(rows) == len(long)


def test_contexts_are_bounded_by_their_share(shipped, monkeypatch):
    monkeypatch.setattr(urls, "MOST_CONTEXTS", 20)
    rows = shipped.createDataFrame([(f"http://{i}.com/{i * i}", "allow") for i in range(200)], "url string, verdict string")
    found = urls._count_contexts(rows)["allow"]
    by_length = {}
    for context in found:
        by_length[len(context)] = by_length.get(len(context), 0) + 1
    assert max(by_length.values()) <= 20 and set(by_length) == set(range(6))


def test_calibration_takes_the_best_cut():
    assert urls.calibrate([(-2, False), (-1, False), (1, True), (3, True)]) == 0
    assert urls.calibrate([(1, False), (2, False), (5, True)]) == 3.5
    assert urls.calibrate([(1, True)]) == 0


def test_contexts_out_of_memory_count_as_well(shipped, monkeypatch):
    """With few contexts in memory and the scores ranked in Spark, scores are the same as with all in memory."""
    given = [f"http://{c}{i % 7}.{'com' if i % 3 else 'net/fr'}/{i * i % 89}é😀" for i, c in enumerate("abcdefgh" * 40)]
    given += [f"http://{c}.org/{i * 7 % 97}" for i, c in enumerate("abcdefgh" * 10)] + ["", None, "\x02a", "http://x.org/" + "ab1/" * 9]
    pages = shipped.createDataFrame([(i, u) for i, u in enumerate(given * 2)], "page_id long, url string")
    want = {r["page_id"]: r for r in urls.filter_urls(pages).collect()}
    monkeypatch.setattr(urls, "MOST_CONTEXTS", 5)
    monkeypatch.setattr(urls, "SAMPLED_URLS", 3)
    monkeypatch.setattr(urls, "_STRETCH", 7)
    got = {r["page_id"]: r for r in urls.filter_urls(pages).collect()}
    assert got.keys() == want.keys()
    for key, row in got.items():
        assert row["score"] == pytest.approx(want[key]["score"], abs=1e-9) and row["verdict"] == want[key]["verdict"]


def test_the_threshold_comes_from_all_scores(shipped, monkeypatch):
    draw = random.Random(5)
    for size in (1, 40, 3_000):
        scored = [(draw.choice([draw.gauss(0, 1), draw.randrange(-3, 3) / 2]), draw.random() < 0.4) for _ in range(size)]
        monkeypatch.setattr(urls, "SAMPLED_URLS", size)
        few = shipped.createDataFrame(scored, "difference double, allowed boolean")
        assert urls.threshold(few) == urls.calibrate(scored)
        monkeypatch.setattr(urls, "SAMPLED_URLS", 0)
        assert urls.threshold(few) == urls.calibrate(scored)
