import random
import re

import numpy as np
import pytest

from postloom.llm import minhash
from postloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*(words[i:] for i in range(width))))


def plain(docs, width, percent=80):
    """(id, size, component) by comparing all pairs."""
    sets = [shingles(t, width) for _, t in docs]
    parent = list(range(len(docs)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                if a == b or 100 * len(a & b) >= percent * len(a | b):
                    parent[find(i)] = find(j)
    members = {}
    for i in range(len(docs)):
        members.setdefault(find(i), []).append(docs[i][0])
    least = {r: min((m for m in ms if m is not None), default=None) for r, ms in members.items()}
    return [(docs[i][0], len(sets[i]), least[find(i)]) for i in range(len(docs))]


def key(row):
    return tuple((v is None, v or 0) for v in row)


def check(rows, docs, width=4):
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=key)
    assert found == sorted(plain(docs, width), key=key)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_whole_table_equals_brute_force(shipped):
    docs = [(r["doc_id"], r["text"]) for r in shipped.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    check(QUERIES["op1_minhash_dedup"](shipped, FOLDER).collect(), docs)


@pytest.mark.parametrize("width", [4, 5])
def test_chains_groups_and_bounds(documents, width):
    """Groups of near copies around the bound, chains of them, and a large group of copies."""
    draw = random.Random(width)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []

    def add(words):
        rows.append((len(rows), " ".join(words), "en", "s"))

    for _ in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([6, 25, 60, 120]))]
        for _ in range(draw.randint(1, 7)):
            add(base)
            # A chain: each copy changes a word of the last one.
            base = list(base)
            base[draw.randrange(len(base))] = draw.choice(vocabulary)
    base = [draw.choice(vocabulary) for _ in range(100)]
    for _ in range(60):
        words = list(base)
        words[draw.randrange(100)] = draw.choice(vocabulary)
        add(words)
    for _ in range(40):
        add(base)
    draw.shuffle(rows)
    found = minhash.near_duplicates(documents(rows), width=width).collect()
    check(found, [(r[0], r[1]) for r in rows], width)


def test_links_that_no_hub_has_are_found(shipped, monkeypatch):
    """Seven clusters that share a bucket: links inside most of them are not with a hub."""
    monkeypatch.setattr(minhash, "CHUNK", 8)  # the bucket is cut into tiles
    sets = {i: np.arange(100, dtype=np.uint64) + np.uint64(1000 * (i % 7)) for i in range(28)}
    buckets = shipped.createDataFrame([(5, i) for i in sets], "key long, node long")
    rows = [(i, bytearray(s.tobytes()), bytearray(minhash.signature(s, 240).astype(np.uint16).tobytes())) for i, s in sets.items()]
    table = shipped.createDataFrame(rows, "node long, set binary, sign binary")
    roots = {r["node"]: r["root"] for r in minhash._link_classes(buckets, table, 80).collect()}
    assert all((roots.get(i, i) == roots.get(j, j)) == (i % 7 == j % 7) for i in sets for j in sets)


def test_signature_estimates_the_similarity():
    draw = np.random.default_rng(2)
    a = np.unique(draw.integers(0, 2**63, 3_000).astype(np.uint64))
    b = np.concatenate([a[:2_000], np.unique(draw.integers(0, 2**63, 1_000).astype(np.uint64))])
    same = (minhash.signature(a, 2_000) == minhash.signature(b, 2_000)).mean()
    assert abs(same - 2_000 / 4_000) < 0.05


def test_odd_rows(odd_documents, empty_documents):
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    check(minhash.near_duplicates(odd_documents).collect(), docs)
    assert minhash.near_duplicates(empty_documents).count() == 0
    kept = minhash.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 5, 6, 7, 9, None}
    assert minhash.one_of_each(empty_documents).count() == 0


def test_one_physical_row_of_each_component_stays(documents):
    text = "one two three four five six seven eight nine ten eleven twelve"
    other = "red orange yellow green blue indigo violet black white grey brown pink"
    rows = [(1, text, "en", "s"), (1, text, "en", "s"), (4, text, "en", "s"), (4, text, "en", "s"), (1, text.upper(), "en", "s")]
    rows += [(None, other, "en", "s"), (None, other, "en", "s"), (None, other.upper(), "en", "s")]
    rows += [(7, None, "en", "s"), (7, None, "en", "s"), (8, None, "en", "s"), (9, "", "en", "s"), (10, "single", "en", "s")]
    frame = documents(rows)
    kept = minhash.one_of_each(frame)
    assert kept.columns == frame.columns
    found = sorted(((r["doc_id"], (r["text"] or "").lower()) for r in kept.collect()), key=key)
    assert found == sorted([(1, text), (None, other), (7, ""), (8, ""), (9, ""), (10, "single")], key=key)
