"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document's set is that of its distinct shingles of `width` words; a document with fewer words has
its whole sequence as the only one, a document without words the empty set. Two permutations of the
32-bit universe give the whole signature: the first scatters the shingles, the second, circularly
shifted by k, gives coordinate k (its minimum over the scattered set). BANDS bands of ROWS
coordinates make the buckets; at a similarity of 0.8 a pair is missed with a probability of 5e-6.

Documents with equal sets are one class. Buckets name candidate pairs of classes, and a pair is
linked when the full sets, as 64-bit hashes, have a Jaccard similarity of at least `percent` / 100,
in whole numbers. Only components are asked for, so buckets are not expanded into all their pairs.
First, each class is verified against a few hubs: under each of HUBS random orders the first class it
meets in any bucket. That joins nearly all that belongs together, a few pairs per class. Second, the
buckets that still hold several components are searched for pairs across components, tile by tile
(a pair of chunks of bounded size), in memory: by signatures first, then on the sets of the classes
that these leave. Pairs whose signatures agree in too few places for the
bound, by 5 standard deviations, are not similar (a chance of 3e-7 at the bound); all others are
verified on their sets. A tile gives no more links than join its components. No pair of a bucket is
passed over. Hubs with many partners are dealt over tasks.

Null and empty texts have no words, and such documents are their own component. Ties of ids: rows
that repeat an id are linked by their texts like any others, and a component's id is its smallest id
that is not null. Documents without an id are linked too; alone, their component is null. Further
columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import grouped, mix64
from postloom.llm.graph import components
from postloom.session import store

BANDS, ROWS = 40, 6
PERCENT = 80
HUBS = 3
# Classes, and shingles of their sets, of a bucket that are compared with as many others in one task.
CHUNK = 256
CHUNK_SHINGLES = 1_000_000
DEVIATIONS = 5
# Partners of one pivot that are compared in one task.
PARTNERS = 256

_UNIVERSE = np.uint32
_STEP = 256  # shingles that are hashed at a time
_BASE = np.uint64(0x9FB21C651E98DF25)


def word_hashes(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, A-Z lower-cased."""
    words = text.lower().split() if text else []
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes."""
    words = word_hashes(text)
    if not len(words):
        return words
    span = min(width, len(words))
    hashes = np.full(len(words) - span + 1, span, dtype=np.uint64)
    for i in range(span):
        hashes = hashes * _BASE + words[i : len(words) - span + 1 + i]
    return np.unique(mix64(hashes))


def _permute(values: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit numbers, in place."""
    shifted = np.empty_like(values)
    for by, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
        np.right_shift(values, _UNIVERSE(by), out=shifted)
        values ^= shifted
        if factor:
            values *= _UNIVERSE(factor)
    return values


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the minimum of the second permutation, shifted by k, over the
    set scattered by the first."""
    scattered = (mix64(shingles ^ _BASE) >> np.uint64(32)).astype(_UNIVERSE)
    shifts = np.arange(size, dtype=_UNIVERSE)
    least = np.full(size, np.iinfo(_UNIVERSE).max, dtype=_UNIVERSE)
    for at in range(0, len(scattered), _STEP):
        np.minimum(least, _permute(scattered[at : at + _STEP, None] - shifts).min(axis=0), out=least)
    return least


def band_keys(sign: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit bucket key per band."""
    rows = sign.reshape(bands, -1).astype(np.uint64)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows.shape[1]):
        keys = mix64(keys * _BASE + rows[:, i])
    return keys.view(np.int64)


def _sketches(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), width)
                sizes.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                keys.append(band_keys(signature(shingles, bands * rows), bands) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("id", "row", "rest")], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "row", "rest", "size", "digest", "keys"],
            )

    return run


def _sets(width: int, size: int):
    """Rows (node, digest, text) to (node, set, sign) where the text has the digest; `sign` has 16 bits of
    each coordinate of the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets, signs = [], [], []
            for node, digest, text in zip(batch.column("node").to_pylist(), batch.column("digest").to_pylist(), batch.column("text")):
                shingles = shingle_set(text.as_py(), width)
                if xxhash.xxh3_128_digest(shingles.tobytes()) == digest:
                    nodes.append(node)
                    sets.append(shingles.tobytes())
                    signs.append(signature(shingles, size).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary()), pa.array(signs, pa.binary())], names=["node", "set", "sign"])

    return run


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have a Jaccard similarity of at least percent / 100."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _verify(percent: int):
    """Rows sorted by (pivot, part), in each the pivot's own set first, to the linked pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, None
        for batch in batches:
            left, right = [], []
            for pivot, part, node, content in zip(*(batch.column(c) for c in ("pivot", "part", "node", "set"))):
                pivot, part, node = pivot.as_py(), part.as_py(), node.as_py()
                own = np.frombuffer(content.as_buffer(), dtype=np.uint64)
                if node == pivot:
                    group, held = (pivot, part), own.copy()
                elif group == (pivot, part) and similar(held, own, percent):
                    left.append(pivot)
                    right.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The stored pairs (pivot, node) whose sets are similar, as edges (a, b); stored."""
    parts = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("parts"))
    members = pairs.join(parts, "pivot").select("pivot", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node")
    pivots = parts.select("pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("pivot").alias("node"))
    filled = members.unionByName(pivots).join(sets.select("node", "set"), "node").select("pivot", "part", "node", "set")
    # False sorts first: the pivot itself.
    sorted_rows = filled.withColumn("other", F.col("node") != F.col("pivot")).repartition("pivot", "part").sortWithinPartitions("pivot", "part", "other")
    return store(sorted_rows.select("pivot", "part", "node", "set").mapInArrow(_verify(percent), "a long, b long"), "linked")


def _hubs(buckets: DataFrame) -> DataFrame:
    """(pivot, node): each class with the first class that it meets, under each of HUBS random orders."""
    order = [F.struct(F.xxhash64("node", F.lit(i)).alias("rank"), F.col("node").alias("node")) for i in range(HUBS)]
    firsts = buckets.groupBy("key").agg(*[F.min(o).alias(f"first_{i}") for i, o in enumerate(order)])
    met = buckets.join(firsts, "key").groupBy("node").agg(*[F.min(f"first_{i}").alias(f"first_{i}") for i in range(HUBS)])
    each = met.select("node", F.explode(F.array_distinct(F.array(*[f"first_{i}.node" for i in range(HUBS)]))).alias("pivot"))
    return each.where("pivot != node").select("pivot", "node")


def shared_with(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of a sorted set with other sets, none of them empty."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    starts = np.cumsum([0, *map(len, others[:-1])])
    return np.add.reduceat((own[at] == flat).astype(np.int64), starts)


def _partners(tile: pa.RecordBatch, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of the tile's first chunk with the rows it meets that may be similar to it: their sizes
    fit and their signatures agree in enough places."""
    chunks, first = tile.column("chunk").to_numpy(), tile.column("t1")[0].as_py()
    across = first != tile.column("t2")[0].as_py()
    sizes = tile.column("size").to_numpy()
    signs = np.stack([np.frombuffer(x.as_buffer(), dtype=np.uint16) for x in tile.column("sign")])
    share = percent / 100
    needed = signs.shape[1] * share - DEVIATIONS * np.sqrt(signs.shape[1] * share * (1 - share))
    one = np.flatnonzero(chunks == first) if across else np.arange(len(sizes))
    other = np.flatnonzero(chunks != first) if across else one
    for i in one.tolist():
        rest = other if across else other[i + 1 :]
        rest = rest[100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])]
        yield i, rest[(signs[rest] == signs[i]).sum(axis=1) >= needed]


def _candidates(percent: int):
    """The rows of each tile that may be similar to one of another component there; no pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in grouped(batches, ["key", "t1", "t2"]):
            comps = tile.column("comp").to_numpy()
            found = np.zeros(tile.num_rows, dtype=bool)
            for i, rest in _partners(tile, percent):
                rest = rest[comps[rest] != comps[i]]
                found[rest] = True
                found[i] |= len(rest) > 0
            if found.any():
                yield tile.select(["key", "t1", "t2", "chunk", "node", "comp"]).filter(pa.array(found))

    return run


def _tile_links(tile: pa.RecordBatch, percent: int) -> tuple[list[int], list[int]]:
    """Similar pairs that join the components of a tile: no more than join them."""
    nodes = tile.column("node").to_numpy()
    _, comps = np.unique(tile.column("comp").to_numpy(), return_inverse=True)
    sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in tile.column("set")]
    sizes = tile.column("size").to_numpy()
    left: list[int] = []
    right: list[int] = []
    for i, rest in _partners(tile, percent):
        rest = rest[comps[rest] != comps[i]]
        if len(rest):
            shared = shared_with(sets[i], [sets[j] for j in rest])
            for j in rest[100 * shared >= percent * (sizes[rest] + sizes[i] - shared)].tolist():
                if comps[j] != comps[i]:
                    comps[comps == comps[j]] = comps[i]
                    left.append(int(nodes[i]))
                    right.append(int(nodes[j]))
    return left, right


def _tiles(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in grouped(batches, ["key", "t1", "t2"]):
            left, right = _tile_links(tile, percent)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return run


def _across(buckets: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between components whose classes share a bucket; stored."""
    placed = buckets.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("comp"))
    signs = store(sets.select("node", F.expr("length(set) div 8").alias("size"), "sign"), "signs")
    sized = placed.join(signs.select("node", "size"), "node")
    open_keys = sized.groupBy("key").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("size") / CHUNK_SHINGLES)).cast("int").alias("chunks"),
    )
    rows = store(placed.join(open_keys.where("low != high").select("key", "chunks"), "key"), "open-buckets")
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    # Chunk i of a bucket meets every chunk j in the tile of (i, j).
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "key", "node", "comp", "chunk", F.least("chunk", "other").alias("t1"), F.greatest("chunk", "other").alias("t2")
    )

    def tiles(members: DataFrame) -> DataFrame:
        return members.repartition("key", "t1", "t2").sortWithinPartitions("key", "t1", "t2")

    # Signatures first: only the sets of classes that may be linked are moved to their tiles.
    kept = tiles(dealt.join(signs, "node")).mapInArrow(_candidates(percent), "key long, t1 int, t2 int, chunk int, node long, comp long")
    full = store(kept, "candidates").join(sets.select("node", F.expr("length(set) div 8").alias("size"), "set", "sign"), "node")
    found = tiles(full).select("key", "t1", "t2", "chunk", "node", "comp", "size", "set", "sign").mapInArrow(_tiles(percent), "a long, b long")
    return store(found.distinct(), "linked")


def _link_classes(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components (node, root) over all similar pairs that share a bucket."""
    roots = components(_linked(store(_hubs(buckets), "pairs"), sets, percent))
    further = _across(buckets, sets, roots, percent)
    if further.isEmpty():
        return roots
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(further))


def _row(key: Column, text: Column) -> tuple[Column, Column]:
    """Two hashes that together stand for a document: its id and text. The seed comes first, so that
    they do not depend on each other."""
    return F.xxhash64(F.lit(1), key, text), F.xxhash64(F.lit(2), key, text)


def find_components(
    docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 4, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(id, row, rest, size, root, component): per row of the input its id, two hashes of id and text, the
    size of its set, a number of its component (null without words) and the component's smallest id."""
    row, rest = _row(F.col(key).cast("long"), F.col(text))
    inputs = docs.select(F.col(key).cast("long").alias("id"), row.alias("row"), rest.alias("rest"), F.col(text).cast("binary").alias("text"))
    sketched = store(inputs.mapInArrow(_sketches(width, bands, rows), "id long, row long, rest long, size long, digest binary, keys array<long>"), "sketches")
    # The number of a class is fixed by the stored table, whatever task writes it.
    classes = store(
        sketched.where(F.col("digest").isNotNull()).groupBy("digest")
        .agg(F.min("row").alias("row"), F.first("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    members = classes.select("node", F.explode("keys").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = store(members.join(shared, "key", "left_semi").select("key", "node"), "buckets")
    named = buckets.select("node").distinct().join(classes.select("node", "digest", F.col("row").alias("of_row")), "node")
    texts = inputs.select("row", "text").join(named, F.col("row") == F.col("of_row")).select("node", "digest", "text")
    sets = store(texts.mapInArrow(_sets(width, bands * rows), "node long, set binary, sign binary"), "sets")
    # Rows that repeat an id and text give their set again.
    sets = sets.groupBy("node").agg(F.first("set").alias("set"), F.first("sign").alias("sign")) if _repeats(sets) else sets
    roots = _link_classes(buckets, sets, percent)
    placed = sketched.select("id", "row", "rest", "size", "digest").join(classes.select("digest", "node"), "digest", "left")
    placed = placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = store(placed.select("id", "row", "rest", "size", "root"), "placed")
    # Stored apart from the join with it, so that Spark can split the join at a large component.
    smallest = store(placed.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("id").alias("least")), "smallest")
    return placed.join(smallest, "root", "left").select(
        "id", "row", "rest", "size", "root", F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component")
    )


def _repeats(sets: DataFrame) -> bool:
    return not sets.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 4, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    found = find_components(docs, text, key, width, percent)
    return found.select(
        F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row of each component, all columns as they were: that of the smallest id.

    Of several texts under that id, and of a component without ids, the row of the smallest hash of id
    and text stays; of rows that repeat an id and its text, one does.
    """
    found = find_components(docs, text, key, width, percent)
    # Stored apart from the aggregates, so that Spark can split the join before them at a large component.
    least = store(found.where(F.col("id").eqNullSafe(F.col("component"))).select("row", "rest", "root"), "least")
    document = F.struct("row", "rest")
    rivals = least.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(document).alias("first"), F.max(document).alias("last"))
    rivals = store(rivals.where("first <> last").select("root", F.col("first.row").alias("r"), F.col("first.rest").alias("s")), "rivals")
    gone = found.where(~F.col("id").eqNullSafe(F.col("component"))).select("row", "rest")
    gone = gone.union(least.join(rivals, "root").where((F.col("row") != F.col("r")) | (F.col("rest") != F.col("s"))).select("row", "rest"))
    names = [F.col("row").alias("_minhash_row"), F.col("rest").alias("_minhash_rest")]
    gone = gone.select(*names).distinct()
    row, rest = _row(F.col(key).cast("long"), F.col(text))
    keyed = docs.withColumns({"_minhash_key": row, "_minhash_key_rest": rest})
    same = (F.col("_minhash_key") == F.col("_minhash_row")) & (F.col("_minhash_key_rest") == F.col("_minhash_rest"))
    kept = keyed.join(gone, same, "left_anti")
    copies = least.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").select("_minhash_row", "_minhash_rest")
    copies = store(copies, "copies")
    if copies.isEmpty():
        return kept.select(*docs.columns)
    # Only the rows that are there more than once are moved to meet their copies.
    single = kept.join(copies, same, "left_anti")
    repeated = kept.join(copies, same, "left_semi").dropDuplicates(["_minhash_key", "_minhash_key_rest"])
    return single.union(repeated).select(*docs.columns)
