"""Approximate nearest neighbours by an inverted multi-index, for the largest inner product.

Vectors are cut into two halves, and each half is quantised by its own centroids, learned from a
bounded sample. Every vector is entered in the cell of its two centroids. A query visits cells in
order of the sum of its half scores; a heap yields the next best pair of centroids. It goes in two
legs. The first visits cells until they hold FIRST_ENTRIES entries, and the exact scores of these
give the k-th best so far. The second goes on until no further cell can be expected to hold a better
entry: until the sum and REACH standard deviations of a cell's residuals stay below that score.
All entries of visited cells are reranked by their exact inner product in double precision.

No list is cut: cells with many entries, or many queries, are dealt over tasks in blocks. Queries and
entries meet by first centroid.

Vectors are compared with those of their own length; each length that LEAST_INDEXED rows have gets its
own index, and vectors of rarer lengths are compared with all of theirs. Vectors that are null, empty,
zero or hold null or non-finite numbers, and rows without an id, take no part. Rows that repeat an id count once, with the smallest of their vectors. A query's own id is never its neighbour;
ties go to the smaller id; with fewer candidates than k a query gets all that there are.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import hash_sample
from postloom.llm.lattice import usable
from postloom.session import store

# The centroids are learned from about this many vectors.
SAMPLED_VECTORS = 8_192
MOST_CENTROIDS = 1_024
LLOYD_STEPS = 12
FIRST_ENTRIES = 1_000
REACH = 3.3
# Sizes of the blocks that meet in one task.
ROWS_PER_BLOCK = 8_192
QUERIES_PER_BLOCK = 2_048
QUERIES_PER_TASK = 4_096
# Vectors of a length that fewer have are all compared.
LEAST_INDEXED = 256
_NEAR = 1e-9  # more than a matrix product can differ from a plain sum, for vectors of about unit length


def centroids_for(rows: int) -> int:
    """A power of two such that the cells hold about 64 rows on average."""
    return int(min(MOST_CENTROIDS, 2 ** max(0, round(np.log2(max(rows, 64) / 64) / 2))))


def quantise(half: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row; the first one at a tie."""
    return ((centroids**2).sum(axis=1) - 2 * half @ centroids.T).argmin(axis=1)


def learn_centroids(half: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """Lloyd's algorithm on a bounded sample."""
    unique = np.unique(half, axis=0)
    centroids = unique[np.random.default_rng(seed).permutation(len(unique))[:k]]
    for _ in range(LLOYD_STEPS):
        nearest = quantise(half, centroids)
        counts = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, half)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


@dataclass
class Codebook:
    first: np.ndarray
    second: np.ndarray

    @property
    def cut(self) -> int:
        return self.first.shape[1]

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return quantise(vectors[:, : self.cut], self.first), quantise(vectors[:, self.cut :], self.second)


def pairs_by_sum(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs (sum, i, j) of two score lists, largest sum first, by a heap of next candidates."""
    rows, columns = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    a, b = first[rows].tolist(), second[columns].tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        total, x, y = heapq.heappop(heap)
        yield -total, rows[x], columns[y]
        # Each pair has one parent: down the first list only from the start of the second.
        if y + 1 < len(b):
            heapq.heappush(heap, (-(a[x] + b[y + 1]), x, y + 1))
        if y == 0 and x + 1 < len(a):
            heapq.heappush(heap, (-(a[x + 1] + b[0]), x + 1, 0))


def build(rows: DataFrame) -> tuple[DataFrame, Codebook, np.ndarray, np.ndarray, np.ndarray]:
    """The index of rows (vec_id, vector): stored entries with their cell (i, j), the codebook, the
    entries per cell, and the mean squared residual per component of each centroid of both halves.

    What comes to the driver is the sample and one row per cell, at most MOST_CENTROIDS squared.
    """
    k = centroids_for(rows.count())
    picked = hash_sample(rows.withColumn("all", F.lit(0)), "all", ["vec_id"], SAMPLED_VECTORS).orderBy("vec_id")
    sample = np.array(picked.select("vector").toArrow().column("vector").to_pylist(), dtype=np.float64)
    cut = (sample.shape[1] + 1) // 2
    book = Codebook(learn_centroids(sample[:, :cut], k), learn_centroids(sample[:, cut:], k))

    def enter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                vectors = np.stack(frame["vector"].to_numpy()).astype(np.float64)
                i, j = book.cells(vectors)
                yield frame.assign(
                    i=i, j=j,
                    off_i=((vectors[:, : book.cut] - book.first[i]) ** 2).sum(axis=1),
                    off_j=((vectors[:, book.cut :] - book.second[j]) ** 2).sum(axis=1),
                )

    schema = "vec_id long, vector array<double>, i int, j int, off_i double, off_j double"
    entries = store(rows.mapInPandas(enter, schema), "index")
    counts = np.zeros((len(book.first), len(book.second)), dtype=np.int64)
    off = np.zeros((2, *counts.shape))
    for row in entries.groupBy("i", "j").agg(F.count("*").alias("n"), F.sum("off_i").alias("a"), F.sum("off_j").alias("b")).collect():
        counts[row["i"], row["j"]] = row["n"]
        off[:, row["i"], row["j"]] = row["a"], row["b"]
    spread_i = off[0].sum(axis=1) / np.maximum(counts.sum(axis=1), 1) / max(book.first.shape[1], 1)
    spread_j = off[1].sum(axis=0) / np.maximum(counts.sum(axis=0), 1) / max(book.second.shape[1], 1)
    return entries, book, counts, spread_i, spread_j


def _visits(book: Codebook, counts: np.ndarray, spread_i: np.ndarray, spread_j: np.ndarray, first_entries: int, reach: float):
    """Per query and first centroid the second centroids to visit. Without a score to beat (`floor`)
    the first leg, with one the second leg."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: list[tuple] = []
            for query, vector, floor in zip(frame["query_id"], frame["vector"], frame["floor"]):
                v = np.asarray(vector, dtype=np.float64)
                one, two = v[: book.cut], v[book.cut :]
                norms = (one**2).sum(), (two**2).sum()
                widest = reach * np.sqrt(norms[0] * spread_i.max() + norms[1] * spread_j.max())
                second_leg = not np.isnan(floor)
                held, visited = 0, {}
                for total, i, j in pairs_by_sum(book.first @ one, book.second @ two):
                    past_first = held >= first_entries
                    if past_first and (not second_leg or total + widest < floor):
                        break
                    held += counts[i, j]
                    if counts[i, j] and past_first == second_leg:
                        deviation = np.sqrt(norms[0] * spread_i[i] + norms[1] * spread_j[j])
                        if not second_leg or total + reach * deviation >= floor:
                            visited.setdefault(i, []).append(j)
                out.extend((query, vector, floor, i, sorted(js)) for i, js in visited.items())
            yield pd.DataFrame(out, columns=["query_id", "vector", "floor", "i", "js"])

    return run


def _best(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    return frame.sort_values(["score", "vec_id"], ascending=[False, True], kind="stable").head(k)


def _rerank(k: int):
    """The k best entries per query within one block of queries and one of entries."""

    def run(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(queries) or not len(entries):
            return pd.DataFrame(columns=columns)
        # Of equal vectors only the k + 1 smallest ids can be among the k best without the query's own.
        entries = entries.assign(same=[v.tobytes() for v in entries["vector"]]).sort_values("vec_id")
        entries = entries[entries.groupby("same").cumcount() <= k]
        vectors = np.stack(entries["vector"].to_numpy()).astype(np.float64)
        ids, seconds = entries["vec_id"].to_numpy(), entries["j"].to_numpy()
        found = []
        for at in range(0, len(queries), 256):
            part = queries.iloc[at : at + 256]
            own = np.stack(part["vector"].to_numpy()).astype(np.float64)
            rough = own @ vectors.T
            for query, vector, floor, js, scores in zip(part["query_id"], own, part["floor"], part["js"], rough):
                visited = np.zeros(int(seconds.max()) + 1, dtype=bool)
                js = np.asarray(js)
                visited[js[js < len(visited)]] = True
                open_to = visited[seconds] & (ids != query)
                if not np.isnan(floor):
                    open_to &= scores >= floor - _NEAR * (1 + abs(floor))
                rows = np.flatnonzero(open_to)
                if len(rows) > k:
                    least = np.partition(scores[rows], len(rows) - k)[len(rows) - k]
                    rows = rows[scores[rows] >= least - _NEAR * (1 + abs(least))]
                exact = (vectors[rows] * vector).sum(axis=1)
                order = np.lexsort((ids[rows], -exact))[:k]
                found.append(pd.DataFrame({"query_id": query, "vec_id": ids[rows[order]], "score": exact[order]}))
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame(columns=columns)

    return run


def _leg(queries: DataFrame, entries: DataFrame, visits, row_blocks: list[int], k: int) -> DataFrame:
    """The k best entries per query and block, over the cells that one leg visits."""
    # So many parts that all cores search, and none for long.
    parts = max(2 * queries.sparkSession.sparkContext.defaultParallelism, -(-queries.count() // QUERIES_PER_TASK))
    spread = queries.select("query_id", "vector", "floor").repartition(parts, "query_id")
    wanted = store(spread.mapInPandas(visits, "query_id long, vector array<double>, floor double, i int, js array<int>"), "visits")
    # Blocks per first centroid: one number for each of at most MOST_CENTROIDS of them.
    per_list = {r["i"]: r["n"] for r in wanted.groupBy("i").agg(F.count("*").alias("n")).collect()}
    query_blocks = [-(-per_list.get(i, 0) // QUERIES_PER_BLOCK) or 1 for i in range(len(row_blocks))]

    def of_list(blocks: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(b) for b in blocks]), F.col("i") + 1)

    def block(key: str, blocks: list[int]) -> Column:
        return F.pmod(F.xxhash64(key), of_list(blocks)).cast("int")

    def every(blocks: list[int]) -> Column:
        return F.explode(F.sequence(F.lit(0), of_list(blocks) - 1))

    asked = wanted.withColumn("qb", block("query_id", query_blocks)).withColumn("rb", every(row_blocks))
    held = entries.where(F.col("i").isin([i for i in per_list])).select("vec_id", "vector", "i", "j")
    held = held.withColumn("rb", block("vec_id", row_blocks)).withColumn("qb", every(query_blocks))
    keys = ["i", "rb", "qb"]
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(_rerank(k), "query_id long, vec_id long, score double")


def _top(found: DataFrame, k: int) -> DataFrame:
    found = found.withColumn("rank", F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)"))
    return found.where(F.col("rank") <= k)


def _search_all(rows: DataFrame, queries: Column, k: int) -> DataFrame:
    """The k best for each query by a comparison with every row of its length; for lengths of few rows."""
    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), "vector", F.lit(float("nan")).alias("floor"), F.size("vector").alias("of"))
    asked = asked.withColumn("js", F.array(F.lit(0)))
    held = rows.select("vec_id", "vector", F.size("vector").alias("size"), F.lit(0).alias("j"))
    found = asked.groupBy("of").cogroup(held.groupBy("size")).applyInPandas(_rerank(k), "query_id long, vec_id long, score double")
    return _top(found, k).select("query_id", "rank", "vec_id", "score")


def search(
    vectors: DataFrame, queries: Column, k: int = 20, embedding: str = "embedding", key: str = "vec_id",
    first_entries: int = FIRST_ENTRIES, reach: float = REACH,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for each row that `queries`, a condition
    on the column `vec_id`, selects."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rows = store(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")), "indexed")
    # A row per length; those with an index of their own have LEAST_INDEXED rows or more.
    lengths = {r["size"]: r["n"] for r in rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).collect()}
    large = sorted(size for size, n in lengths.items() if n >= LEAST_INDEXED)
    found = [_search_length(rows if len(lengths) == 1 else rows.where(F.size("vector") == size), queries, k, first_entries, reach) for size in large]
    if len(large) < len(lengths) or not lengths:
        found.append(_search_all(rows.where(~F.size("vector").isin(large)), queries, k))
    return reduce(DataFrame.unionByName, found)


def _search_length(rows: DataFrame, queries: Column, k: int, first_entries: int, reach: float) -> DataFrame:
    """The search among vectors of one length."""
    entries, book, counts, spread_i, spread_j = build(rows)
    row_blocks = [-(-int(n) // ROWS_PER_BLOCK) or 1 for n in counts.sum(axis=1)]
    visits = _visits(book, counts, spread_i, spread_j, max(first_entries, 4 * k), reach)
    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), "vector", F.lit(float("nan")).alias("floor"))
    first = store(_top(_leg(asked, entries, visits, row_blocks, k), k), "first-leg")
    floors = first.groupBy("query_id").agg(
        F.when(F.max("rank") == k, F.min("score")).otherwise(float("-inf")).alias("floor")
    )
    onward = asked.drop("floor").join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    second = _leg(onward, entries, visits, row_blocks, k)
    both = first.select("query_id", "vec_id", "score").unionByName(second)
    return _top(both, k).select("query_id", "rank", "vec_id", "score")
