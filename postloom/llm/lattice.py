"""Near duplicates among embeddings by lattice hashing.

Each of TABLES hash tables projects the unit vector to eight random directions and decodes the result
to the nearest point of the lattice E8. A vector is in the cell of that point and in the cells of the
PROBES nearest of its 240 neighbours. Two vectors with equal labels that share a cell of any table
are compared by cosine in double precision; at 0.93 and these parameters a pair is missed with a
probability under 1e-4, and far less at higher cosines.

Equal vectors of one label are one class with a number of copies. A cell with many classes is cut
into tiles, pairs of chunks of at most about CHUNK classes, so a cell of any size is spread over
tasks. A tile gives one row per class: its links counted, and a representative of its group there.
A pair that shares several cells is counted in the one with the smallest key.

Labels of any type are compared as they are. Rows with a null label, and vectors that are null, empty, zero or hold null or non-finite numbers,
have no links and are their own component. Vectors of different lengths are never compared. Rows
that repeat an id, its label and vector are one vector; a null id takes part, and a component's id is
its smallest id that is not null. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.llm.common import grouped, mix64
from postloom.llm.graph import components
from postloom.session import store

TABLES = 4
PROBES = 4
WIDTH = 1.5  # how many units of a projected unit vector make one unit of the lattice
CHUNK = 1_024
MIN_COSINE = 0.93
SEED = 20_240


def usable(embedding: Column) -> Column:
    """Neither null, empty, zero nor with null or non-finite components."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(embedding) > 0) & fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def neighbours() -> np.ndarray:
    """The 240 points of E8 nearest to the origin: two entries of size 1, or all of size 1/2 with an
    even number of minus signs."""
    whole = []
    for places in itertools.combinations(range(8), 2):
        for signs in itertools.product((1.0, -1.0), repeat=2):
            point = np.zeros(8)
            point[list(places)] = signs
            whole.append(point)
    halves = [np.array(p) for p in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in p) % 2 == 0]
    return np.array(whole + halves)


def nearest_point(places: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row of eight numbers.

    E8 is D8 (whole numbers with an even sum) and D8 shifted by a half in every direction.
    """

    def in_d8(at: np.ndarray) -> np.ndarray:
        rounded = np.rint(at)
        odd = np.flatnonzero(rounded.sum(axis=1).astype(np.int64) & 1)
        error = at[odd] - rounded[odd]
        worst = np.abs(error).argmax(axis=1)
        rounded[odd, worst] += np.where(error[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
        return rounded

    plain, shifted = in_d8(places), in_d8(places - 0.5) + 0.5
    nearer = ((places - plain) ** 2).sum(axis=1) <= ((places - shifted) ** 2).sum(axis=1)
    return np.where(nearer[:, None], plain, shifted)


class Lattice:
    """The cells of vectors of one length. The same vector has the same cells in any batch."""

    def __init__(self, size: int, tables: int = TABLES, probes: int = PROBES, width: float = WIDTH, seed: int = SEED):
        random = np.random.default_rng([seed, size])
        self.directions = random.standard_normal((tables, size, 8)) / width
        self.factors = random.integers(1, 2**62, size=(tables, 8)) | 1
        self.salts = random.integers(1, 2**62, size=tables).astype(np.uint64)
        self.around, self.probes = neighbours(), probes

    def keys(self, unit: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """One row of tables * (1 + probes) cell keys per unit vector."""
        found = []
        own = mix64(labels.astype(np.int64).view(np.uint64))
        for directions, factors, salt in zip(self.directions, self.factors, self.salts):
            # Summed one component at a time: a matrix product may round differently in another batch.
            places = np.zeros((len(unit), 8))
            for i, direction in enumerate(directions):
                places += unit[:, i : i + 1] * direction
            home = nearest_point(places)
            toward = (places - home) @ self.around.T
            # A rounded key makes ties and last digits irrelevant: equal steps go by their number.
            near = np.argsort(-np.round(toward, 9), axis=1, kind="stable")[:, : self.probes]
            cells = np.concatenate([home[:, None], home[:, None] + self.around[near]], axis=1)
            codes = ((2 * cells).astype(np.int64) * factors).sum(axis=2).view(np.uint64)
            found.append(mix64(mix64(codes ^ salt) ^ own[:, None]))
        return np.concatenate(found, axis=1).view(np.int64)


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1)[:, None]  # squares neither overflow nor vanish
    total = np.zeros(len(vectors))
    for i in range(vectors.shape[1]):
        total += scaled[:, i] ** 2
    return scaled / np.sqrt(total)[:, None]


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows grouped by the length of their vectors: (row numbers, vectors)."""
    raw = batch.column(column)
    values = [np.frombuffer(v.as_buffer(), dtype="<f8") for v in raw]
    lengths = np.array([len(v) for v in values], dtype=np.int64)
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        yield rows, np.stack([values[i] for i in rows])


def _packed(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    """Vectors of doubles as bytes, which shuffle and batch more compactly than lists."""
    for batch in batches:
        vectors = batch.column("embedding")
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("<f8")
        ends = np.cumsum([len(v) for v in vectors]) if len(vectors) else []
        parts = np.split(flat, ends[:-1]) if len(vectors) else []
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in keep], pa.array([p.tobytes() for p in parts], pa.binary())], names=[*keep, "vector"]
        )


def _cells(with_rows: bool):
    """Rows (key) or (key, cls, copies, label, vector): one per class and cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices: dict[int, Lattice] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                labels = part.column("label").to_numpy(zero_copy_only=False)
                for rows, vectors in _by_length(part, "vector"):
                    size = vectors.shape[1]
                    lattice = lattices.setdefault(size, Lattice(size))
                    keys = lattice.keys(_units(vectors), labels[rows])
                    if not with_rows:
                        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel())], names=["key"])
                        continue
                    again = pa.array(np.repeat(rows, keys.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.ravel()), *[part.column(c).take(again) for c in ("cls", "copies", "label", "vector")]],
                        names=["key", "cls", "copies", "label", "vector"],
                    )

    return run


def _local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member of each node's component."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[left], root[right])
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def _counted_here(key: int, left: np.ndarray, right: np.ndarray, step: int = 4_096) -> np.ndarray:
    """Whether `key` is the smallest cell that the two rows of cell keys share."""
    here = np.empty(len(left), dtype=bool)
    for at in range(0, len(left), step):
        a, b = left[at : at + step], right[at : at + step]
        earlier = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a < key)
        here[at : at + step] = ~earlier.any(axis=1)
    return here


def _compare(batch: pa.RecordBatch, lattices: dict[int, Lattice], min_cosine: float) -> pa.RecordBatch | None:
    """The links of one tile: per class its links counted and its representative."""
    key = batch.column("key")[0].as_py()
    chunks, firsts = batch.column("chunk").to_numpy(), batch.column("t1")[0].as_py()
    across = firsts != batch.column("t2")[0].as_py()
    copies, labels, classes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("copies", "label", "cls"))
    links = np.zeros(batch.num_rows, dtype=np.int64)
    lefts, rights = [], []
    for rows, vectors in _by_length(batch, "vector"):
        unit = _units(vectors)
        if across:
            one, other = np.flatnonzero(chunks[rows] == firsts), np.flatnonzero(chunks[rows] != firsts)
        else:
            one = other = np.arange(len(rows))
        if not len(one) or not len(other):
            continue
        a, b = np.nonzero(unit[one] @ unit[other].T >= min_cosine - 1e-9)
        a, b = one[a], other[b]
        keep = (a < b if not across else np.ones(len(a), dtype=bool)) & (labels[rows[a]] == labels[rows[b]])
        a, b = a[keep], b[keep]
        exact = np.concatenate(
            [(unit[a[i : i + 65_536]] * unit[b[i : i + 65_536]]).sum(axis=1) for i in range(0, len(a), 65_536)] or [np.empty(0)]
        ) >= min_cosine
        a, b = a[exact], b[exact]
        if not len(a):
            continue
        lattice = lattices.setdefault(vectors.shape[1], Lattice(vectors.shape[1]))
        linked, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        keys = lattice.keys(unit[linked], labels[rows[linked]])
        here = _counted_here(key, keys[place[: len(a)]], keys[place[len(a) :]])
        a, b = rows[a[here]], rows[b[here]]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        lefts.append(a)
        rights.append(b)
    if not lefts:
        return None
    root = _local_roots(batch.num_rows, np.concatenate(lefts), np.concatenate(rights))
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [pa.array(classes[some], pa.binary()), pa.array(links[some]), pa.array(classes[root[some]], pa.binary())], names=["cls", "links", "root"]
    )


def _tiles(min_cosine: float):
    """Batches sorted by tile: each tile, a bounded number of rows, is compared as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices: dict[int, Lattice] = {}
        for tile in grouped(batches, ["key", "t1", "t2"]):
            found = _compare(tile, lattices, min_cosine) if tile.num_rows > 1 else None
            if found is not None:
                yield found

    return run


def _with_numbers(rows: DataFrame) -> DataFrame:
    """`rows` with a whole number for each label: whole labels as they are, others by a stored list of them."""
    if isinstance(rows.schema["label"].dataType, T.IntegralType):
        return rows.withColumn("label", F.col("label").cast("long"))
    labels = store(rows.select(F.col("label").alias("named")).where("named IS NOT NULL").distinct(), "labels")
    numbered = store(labels.withColumn("number", F.monotonically_increasing_id()), "label-numbers")
    return rows.join(numbered, F.col("label") == F.col("named"), "left").select("vec_id", F.col("number").alias("label"), "embedding")


def link(vectors: DataFrame, embedding: str = "embedding", label: str = "label", key: str = "vec_id", min_cosine: float = MIN_COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("embedding"))
    rows = _with_numbers(rows)
    fit = F.col("label").isNotNull() & usable(F.col("embedding"))
    # The seed comes first, so that the two hashes do not depend on each other.
    digest = F.unhex(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(s), "label", "embedding")), 16, "0") for s in (1, 2)]))
    named = store(rows.select("vec_id", "label", "embedding", F.when(fit, digest).alias("cls")), "vectors")
    members = named.where(F.col("cls").isNotNull()).select("vec_id", "cls").distinct()
    classes = members.groupBy("cls").agg(F.count("*").alias("copies")).join(
        named.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("label").alias("label"), F.min("embedding").alias("embedding")), "cls"
    )
    keep = ["cls", "copies", "label"]
    classes = store(
        classes.select(*keep, "embedding").mapInArrow(lambda b: _packed(b, keep), "cls binary, copies long, label long, vector binary"), "classes"
    )
    # Cells with more classes than a chunk holds.
    large = store(
        classes.mapInArrow(_cells(False), "key long").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK)
        .select(F.col("key").alias("large"), F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")),
        "large-cells",
    )
    cells = classes.mapInArrow(_cells(True), "key long, cls binary, copies long, label long, vector binary")
    parts = cells.join(large, F.col("key") == F.col("large"), "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    parts = parts.withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
    # Chunk i of a cell meets every chunk j in the tile of (i, j).
    dealt = parts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "key", "cls", "copies", "label", "vector", "chunk", F.least("chunk", "other").alias("t1"), F.greatest("chunk", "other").alias("t2")
    )
    tiles = dealt.repartition("key", "t1", "t2").sortWithinPartitions("key", "t1", "t2")
    found = store(tiles.mapInArrow(_tiles(min_cosine), "cls binary, links long, root binary"), "links")
    roots = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cls")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    counted = classes.select("cls", "copies").join(links, "cls", "left").join(roots, "cls", "left").select(
        "cls", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "cls").alias("root")
    )
    placed = store(named.select("vec_id", "cls").join(counted, "cls", "left"), "placed")
    # Stored apart from the join with it, so that Spark can split the join at a large component.
    smallest = store(placed.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("vec_id").alias("component_id")), "smallest")
    out = placed.join(smallest, "root", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).cast("long").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
