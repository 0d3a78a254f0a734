import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from postloom.llm import hard_negatives as hn


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(max(-(2.0**24), min(2.0**24, 256 * float(np.float32(x))))) for x in v]


def plain(rows, every=3, positives=5, negatives=10):
    """All scores of every anchor."""
    kept = {}
    for i, v, label in rows:
        if i is not None and label is not None and whole(v) is not None:
            kept[i] = min(kept.get(i, (label, whole(v))), (label, whole(v)))
    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in kept.items() if i != a and len(w) == len(v)
        )
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(n, i) for n, i, other in scored if other != label and -30 * p <= -100 * n <= -90 * p][:negatives]
            out += [(a, positive, r, i, -p, -n) for r, (n, i) in enumerate(fits, 1)]
    return sorted(out)


def check(embeddings, rows, every=3):
    found = hn.mine(embeddings(rows), F.col("vec_id") % every == 0)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, every)
    return found


@pytest.fixture
def small_pages(monkeypatch):
    monkeypatch.setattr(hn, "PAGE_NUMBERS", 8 * 40)
    monkeypatch.setattr(hn.build, "__defaults__", (8 * 40,))
    monkeypatch.setattr(hn, "ANCHORS_PER_BLOCK", 16)
    monkeypatch.setattr(hn, "PAGES_PER_GROUP", 3)
    monkeypatch.setattr(hn, "GROUPS_PER_CORE", 1)
    monkeypatch.setattr(hn, "PAGES_PER_BLOCK", 4)


def test_clusters_copies_and_ties(embeddings, small_pages):
    draw = np.random.default_rng(3)
    centers = draw.normal(size=(5, 8))
    rows = [(i, (centers[i % 5] + draw.normal(size=8) * draw.choice([0.05, 0.5])).tolist(), int(draw.integers(0, 3))) for i in range(360)]
    # A third of all rows are copies of one vector under two labels: more than a page of them.
    rows += [(1_000 + i, centers[0].tolist(), i % 2) for i in range(180)]
    rows += [(2_000 + i, [0.0] * 8, i % 3) for i in range(9)]
    check(embeddings, rows)


def test_odd_rows(embeddings):
    rows = [
        (0, [1.0, 0.5], 1), (3, [1.0, 0.5], 1), (3, [1.0, 0.5], 1), (3, [2.0, 0.5], 0), (1, [0.5, 0.25], 2), (2, [0.6, 0.2], 2),
        (4, None, 1), (5, [1.0, None], 1), (6, [1.0, math.nan], 1), (9, [math.inf, 1.0], 2), (12, [1.0, 1.0], None),
        (None, [1.0, 0.5], 1), (15, [1.0, 0.5, 0.1], 1), (18, [1.0, 0.4, 0.1], 1), (20, [0.5, 0.2, 0.1], 2),
        (21, [], 1), (22, [], 1), (23, [], 2), (24, [3.4e38, -3.4e38], 1), (27, [3.0e38, 1.0], 1), (28, [2.0e4, 0.0], 5),
    ]
    found = check(embeddings, rows)
    assert found.dtypes == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint"),
    ]
    assert check(embeddings, []).count() == 0
    assert check(embeddings, [(0, [1.0], 1)]).count() == 0


def test_other_columns_and_labels_that_are_not_whole(shipped):
    rows = [(i, [float(i % 5), 1.0], 1.2 if i % 2 else 1.7, "x", i) for i in range(40)]
    frame = shipped.createDataFrame(rows, "vec_id long, embedding array<double>, label double, page string, size long")
    found = hn.mine(frame, F.col("vec_id") % 5 == 0)
    assert sorted(tuple(r) for r in found.collect()) == plain([r[:3] for r in rows], 5)


def test_boxes_bound_scores():
    draw = np.random.default_rng(1)
    ids, vectors = np.arange(500), draw.integers(-300, 300, size=(500, 6)).astype("<i4")
    order = hn.str_order(vectors, ids)
    assert sorted(order) == list(range(500))
    pages = [(ids[order][a:b], vectors[order][a:b]) for a, b in ((0, 400), (400, 430), (430, 500))]
    tree = hn.Tree(pages)
    anchors = draw.integers(-300, 300, size=(4, 6))
    low, high = hn.bounds(anchors, tree.low, tree.high)
    for leaf, (page, rows) in tree.leaves.items():
        part = anchors @ pages[page][1][rows].T
        assert (part.min(axis=1) >= low[:, leaf]).all() and (part.max(axis=1) <= high[:, leaf]).all()
    for root, (_, own) in zip(tree.roots, pages):
        scores = anchors @ own.T
        assert (low[:, root] <= scores.min(axis=1)).all() and (high[:, root] >= scores.max(axis=1)).all()
    assert sorted(i for page, rows in tree.leaves.values() for i in pages[page][0][rows]) == list(range(500))
    every = sorted((-int(s), int(i)) for s, i in zip(anchors[0] @ vectors.T, ids) if s <= 5_000 and i != 3)[:9]
    found = tree.search(anchors[0], low[0].tolist(), high[0].tolist(), [(-(2**62), 5_000)], 9, 3, tree.roots)
    assert sorted((-s, i) for s, i in found[0]) == every
    huge = np.array([[1 << 24] * 5000], dtype=np.int64)
    assert hn._dot(huge, huge.T)[0, 0] == 5000 << 48
