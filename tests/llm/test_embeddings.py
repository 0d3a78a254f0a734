import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from postloom.llm import lattice, multi_index
from postloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def fine(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def plain_links(rows, bound=0.93):
    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    unit = [np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64)) if fine(v) and label is not None else None for _, v, label in rows]
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
                if unit[i] @ unit[j] >= bound:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    members = {}
    for i in range(n):
        members.setdefault(find(i), []).append(rows[i][0])
    return sorted((rows[i][0], links[i], min(members[find(i)])) for i in range(n))


def near(draw, v, cosine):
    v = v / np.linalg.norm(v)
    w = draw.normal(size=len(v))
    w -= w @ v * v
    return cosine * v + math.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def check_links(found, rows):
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == plain_links(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_links_of_the_whole_table(shipped):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in shipped.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check_links(QUERIES["op9_embedding_dedup"](shipped, FOLDER).collect(), rows)


def test_links_of_copies_groups_and_odd_vectors(embeddings, monkeypatch):
    monkeypatch.setattr(lattice, "CHUNK", 16)  # groups are cut into tiles
    draw = np.random.default_rng(4)
    rows = []

    def add(v, label):
        rows.append((len(rows), None if v is None else [None if x is None else float(np.float32(x)) for x in v], label))

    for _ in range(60):
        add(draw.normal(size=24), int(draw.integers(0, 3)))
    center = draw.normal(size=24)
    for _ in range(90):
        add(near(draw, center, 0.985) * float(draw.uniform(0.1, 9)), 1)  # mutual cosines around 0.97
    for _ in range(30):
        add(near(draw, center, draw.uniform(0.9, 0.99)), 1)
    for _ in range(40):
        add(center, 1)
    for label in (None, 2):
        add(center, label)
        add(center, label)
    add(None, 1)
    add([0.0] * 24, 1)
    add([math.nan] * 24, 1)
    add([math.inf] + [1.0] * 23, 1)
    add([None] + [1.0] * 23, 1)
    add([], 1)
    for _ in range(3):
        add(list(center[:8]), 1)  # another length
    check_links(lattice.link(embeddings(rows)).collect(), rows)
    assert lattice.link(embeddings(rows).where("false")).count() == 0


def test_repeated_rows_and_rows_without_id(embeddings):
    v, w = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(7, v, 1), (7, v, 1), (None, v, 1), (9, w, 1), (None, w, 2)]
    found = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in lattice.link(embeddings(rows)).collect() if r["component_id"])
    assert found == [(-1, 1, 7, False), (7, 1, 7, True), (7, 1, 7, True), (9, 0, 9, True)]


def test_nearest_lattice_points():
    around = lattice.neighbours()
    assert around.shape == (240, 8) and np.allclose((around**2).sum(axis=1), 2)
    draw = np.random.default_rng(0)
    places = draw.normal(size=(500, 8)) * 2
    found = lattice.nearest_point(places)
    assert np.allclose(lattice.nearest_point(found), found)
    distance = ((places - found) ** 2).sum(axis=1)
    assert (distance <= 1 + 1e-9).all()  # the covering radius
    others = ((places[:, None] - found[:, None] - around[None]) ** 2).sum(axis=2)
    assert (others >= distance[:, None] - 1e-9).all()


def test_recall_at_the_bound():
    draw = np.random.default_rng(8)
    one = draw.normal(size=(4_000, 64))
    one /= np.linalg.norm(one, axis=1)[:, None]
    other = np.array([near(draw, v, 0.93) for v in one])
    cells = lattice.Lattice(64)
    label = np.zeros(len(one), dtype=np.int64)
    a, b = cells.keys(one, label), cells.keys(other, label)
    assert (a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean() >= 0.998


def exact_nearest(rows, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for i, v in zip(ids, vectors):
        if i % 20 == 0:
            scores = (vectors * v).sum(axis=1)
            order = [x for x in np.lexsort((ids, -scores)) if ids[x] != i][:k]
            out[int(i)] = [(int(ids[x]), float(scores[x])) for x in order]
    return out


def check_search(found, exact, recall):
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert set(got) == {q for q, best in exact.items() if best}
    hits = total = 0
    for q, best in exact.items():
        assert len(got.get(q, [])) == len(best)
        assert got.get(q, []) == sorted(got.get(q, []), key=lambda p: (-p[1], p[0]))
        hits += len({i for i, _ in best} & {i for i, _ in got.get(q, [])})
        total += len(best)
    assert hits >= recall * total
    return got


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.1"])
def test_search_of_the_whole_table(shipped, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in shipped.read.parquet(f"{folder}/embeddings.parquet").collect()]
    exact = exact_nearest(rows, 20)
    got = check_search(QUERIES["op10_nearest"](shipped, folder).collect(), exact, 0.97)
    scores = {(q, i): s for q, best in exact.items() for i, s in best}
    assert all(s == scores[q, i] for q, best in got.items() for i, s in best if (q, i) in scores)


def test_search_with_ties_few_rows_and_odd_vectors(embeddings, monkeypatch):
    monkeypatch.setattr(multi_index, "ROWS_PER_BLOCK", 40)
    monkeypatch.setattr(multi_index, "QUERIES_PER_BLOCK", 4)
    draw = np.random.default_rng(3)
    same = [float(np.float32(x)) for x in draw.normal(size=6)]
    rows = [(i, same if i % 3 else [float(np.float32(x)) for x in draw.normal(size=6)], 1) for i in range(400)]
    good = [(i, v) for i, v, _ in rows]
    rows += [(400, None, 1), (420, [0.0] * 6, 1), (440, [math.nan] * 6, 1), (460, [None] * 6, 1), (480, [1.0] * 5, 1), (None, same, 1), (20, same, 1) if False else (0, rows[0][1], 1)]
    exact = exact_nearest(good, 20)
    got = check_search(multi_index.search(embeddings(rows), F.col("vec_id") % 20 == 0).collect(), exact, 0.9)
    # Equal vectors: the smaller ids first.
    assert all(i % 3 for i, _ in got[20][:5])
    few = embeddings(rows[:5])
    check_search(multi_index.search(few, F.col("vec_id") % 20 == 0).collect(), exact_nearest(good[:5], 20), 1.0)
    assert multi_index.search(few.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_pairs_come_by_sum():
    draw = np.random.default_rng(1)
    a, b = draw.normal(size=9), draw.normal(size=7)
    found = list(multi_index.pairs_by_sum(a, b))
    assert sorted((i, j) for _, i, j in found) == [(i, j) for i in range(9) for j in range(7)]
    assert [s for s, _, _ in found] == sorted((s for s, _, _ in found), reverse=True)


def test_labels_of_any_type(shipped):
    v = [1.0, 2.0, 3.0, 4.0]
    for labels, kind in (([1.2, 1.7, 1.2, None, float("nan"), float("nan")], "double"), (["a", "b", "a", None, "", ""], "string")):
        rows = [(i, v, label) for i, label in enumerate(labels)]
        found = lattice.link(shipped.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == {0: (1, 0), 1: (0, 1), 2: (1, 0), 3: (0, 3), 4: (1, 4), 5: (1, 4)}


def test_search_among_every_length(shipped, monkeypatch):
    """Lengths with an index of their own and rarer ones: each vector finds those of its length."""
    draw = np.random.default_rng(6)
    sizes = [8] * 400 + [5] * 300 + [3] * 40 + [1] * 3
    rows = [(i, draw.normal(size=n).tolist()) for i, n in enumerate(sizes)]
    found = multi_index.search(shipped.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, k=7).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = total = 0
    for i, v in rows[::10]:
        scores = sorted((-float(np.dot(v, w)), j) for j, w in rows if j != i and len(w) == len(v))[:7]
        hits += len({j for _, j in scores} & set(got.get(i, [])))
        total += len(scores)
        assert len(got.get(i, [])) == len(scores)
        if len(v) < 5:
            assert got[i] == [j for _, j in scores]
    assert hits >= 0.97 * total
