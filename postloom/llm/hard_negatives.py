"""Hard negatives by an STR-packed R-tree over whole-number vectors.

Rows of one label and length are packed by sort-tile-recursion. Spark packs the upper levels: positions
by the widest coordinate cut a label into slabs, positions by the next one cut a slab into pages of
equal size, whatever values repeat. Inside a page the recursion goes on over further coordinates down
to leaves of LEAF rows. Every node has the box of its rows, and a box gives each coordinate's product
with an anchor an interval, and so the score as a whole.

An anchor meets the boxes of all pages first, in blocks, and then only the pages that can matter to it,
some at a time. Over these a best-first queue opens nodes by their highest possible score within a window; nodes outside
the window, or strictly below the k-th best so far, are never opened. All pruning is exact: the result
is that of a comparison with every row. Positives are a search among the anchor's own label without a
window, that starts in the anchor's own page; negatives one among the other labels with one window for
each distinct score of a positive.

Components are floor(256 * x), held between -2**24 and 2**24, scores whole numbers: exact. Rows with a
null id, label or vector or with a null or non-finite component take no part, and vectors of different
lengths are never compared. Rows that repeat an id count once, with the smallest label and vector. Ties
go to the smaller id; an anchor without positives, or a positive without negatives, has no rows; empty
tables give empty results. A page is one task's work at a time: PAGE_NUMBERS numbers, copies or not.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import grouped
from postloom.operators.ordering import running_totals
from postloom.session import store

SCALE = 256
MOST = 1 << 24  # components are held between -MOST and MOST
PAGE_NUMBERS = 1 << 17  # numbers in a page: 2,048 vectors of 64
LEAF = 32
FANOUT = 16
# Anchors, pages and their boxes that meet in one task.
ANCHORS_PER_BLOCK = 4_096
PAGES_PER_GROUP, GROUPS_PER_CORE = 16, 4
PAGES_PER_BLOCK = 2_048
_EXACT = float(1 << 53)


def _dot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whole-number matrix product: in doubles where every sum is exact there, else in 64 bits."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(left.shape[-1], 1)
    if most < _EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64)


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and highest score of each anchor with anything inside each box."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _dot(plus, low.T) + _dot(minus, high.T), _dot(plus, high.T) + _dot(minus, low.T)


def str_order(vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The rows in sort-tile-recursive order: runs of `leaf` rows are the leaves."""

    def tiles(rows: np.ndarray, coordinates: list[int]) -> list[np.ndarray]:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1 or not coordinates:
            return [rows]
        rows = rows[np.lexsort((ids[rows], vectors[rows, coordinates[0]]))]
        slabs = int(np.ceil(leaves ** (1 / len(coordinates))))
        per_slab = -(-leaves // slabs) * leaf
        return [t for at in range(0, len(rows), per_slab) for t in tiles(rows[at : at + per_slab], coordinates[1:])]

    spread = np.argsort(-vectors.astype(np.float64).var(axis=0), kind="stable") if vectors.shape[1] else []
    # Each level at least halves what it cuts, so few coordinates are enough.
    levels = max(1, int(np.log2(max(len(vectors) / leaf, 2)) / 2))
    return np.concatenate(tiles(np.arange(len(vectors)), [int(c) for c in spread[:levels]]))


class Tree:
    """The R-trees of some pages: leaves are runs of LEAF rows, nodes runs of FANOUT below them."""

    def __init__(self, pages: list[tuple[np.ndarray, np.ndarray]]):
        self.pages, self.roots = pages, []
        self.leaves: dict[int, tuple[int, slice]] = {}  # node -> page and rows
        self.children: dict[int, range] = {}
        lows, highs, size = [], [], 0
        for number, (ids, vectors) in enumerate(pages):
            below, low, high = range(0), vectors, vectors
            while not below or len(below) > 1:
                width = FANOUT if below else LEAF
                starts = np.arange(0, len(low), width)
                low, high = np.minimum.reduceat(low, starts, axis=0), np.maximum.reduceat(high, starts, axis=0)
                for node, at in enumerate(starts.tolist(), size):
                    if below:
                        self.children[node] = below[at : at + width]
                    else:
                        self.leaves[node] = number, slice(at, at + width)
                lows.append(low)
                highs.append(high)
                below = range(size, size + len(starts))
                size += len(starts)
            self.roots.append(size - 1)
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)

    def search(
        self, anchor: np.ndarray, lowest: list[int], highest: list[int], windows: list[tuple[int, int]], k: int, without: int, roots: list[int]
    ) -> list[list[tuple[int, int]]]:
        """For each window the k best (score, id) inside it, without the anchor's own id, below these roots.

        `lowest` and `highest` are the anchor's bounds of all nodes.
        """
        scored: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        found = []
        for low, high in windows:
            best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst kept one is first
            queue = [(-min(highest[root], high), root) for root in roots if highest[root] >= low and lowest[root] <= high]
            heapq.heapify(queue)
            while queue:
                bound, node = heapq.heappop(queue)
                floor = max(low, best[0][0]) if len(best) == k else low
                if -bound < floor:
                    break
                if node in self.children:
                    for child in self.children[node]:
                        if highest[child] >= floor and lowest[child] <= high:
                            heapq.heappush(queue, (-min(highest[child], high), child))
                    continue
                if node not in scored:
                    page, rows = self.leaves[node]
                    ids, vectors = self.pages[page]
                    scored[node] = _dot(vectors[rows], anchor), ids[rows]
                scores, ids = scored[node]
                fits = (scores >= floor) & (scores <= high) & (ids != without)
                for score, i in zip(scores[fits].tolist(), ids[fits].tolist()):
                    if len(best) < k:
                        heapq.heappush(best, (score, -i))
                    elif (score, -i) > best[0]:
                        heapq.heapreplace(best, (score, -i))
            found.append([(s, -i) for s, i in best])
        return found


@dataclass
class Index:
    """`rows` (vec_id, tribe, page, numbers) and `pages` (page, tribe, size, low, high, ids, vectors).

    A tribe is the rows of one label and length; tribes and pages are known by the position of their
    first row. Pages are searched in so many `groups`, each by one task for a block of anchors.
    """

    rows: DataFrame
    pages: DataFrame
    groups: int

    def group(self, page: str) -> Column:
        return F.pmod(F.xxhash64(page), F.lit(self.groups)).cast("int")


def _matrix(cells: pd.Series, kind: str, rows: int | None = None) -> np.ndarray:
    flat = np.frombuffer(b"".join(cells), dtype=kind)
    rows = len(cells) if rows is None else rows
    return flat.reshape(rows, len(flat) // max(rows, 1))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by page: one packed tree per page."""
    for page in grouped(batches, ["page"]):
        ids = page.column("vec_id").to_numpy()
        size = page.column("size")[0].as_py()
        vectors = np.frombuffer(b"".join(v.as_py() for v in page.column("numbers")), dtype="<i4").reshape(len(ids), size)
        order = str_order(vectors, ids)
        low, high = vectors.min(axis=0), vectors.max(axis=0)
        packed = [ids[order].astype("<i8").tobytes(), vectors[order].tobytes()]
        columns = [[page.column(c)[0].as_py()] for c in ("page", "tribe", "size")] + [[low.tobytes()], [high.tobytes()], *[[p] for p in packed]]
        kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["page", "tribe", "size", "low", "high", "ids", "vectors"])


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = [np.asarray(v.values.to_numpy(), dtype="<i4").tobytes() for v in batch.column("numbers")]
        yield batch.set_column(batch.schema.get_field_index("numbers"), "numbers", pa.array(cells, pa.binary()))


def whole_numbers(embedding: Column) -> Column:
    """floor(256 * x) of every component, held between -MOST and MOST."""
    held = lambda x: F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), x * F.lit(float(SCALE))))
    return F.transform(embedding, lambda x: F.floor(held(x)).cast("int"))


def build(rows: DataFrame, page_numbers: int = PAGE_NUMBERS) -> Index:
    """The index of rows (vec_id, label, numbers); every row is in it."""
    named = store(rows.withColumn("size", F.size("numbers")), "numbers")
    # The two coordinates of the widest spread of each length, the smaller position at a tie.
    spread = named.select("size", F.posexplode("numbers").alias("at", "x")).groupBy("size", "at").agg(F.round(F.var_pop("x"), 3).alias("spread"))
    widest = spread.groupBy("size").agg(F.sort_array(F.collect_list(F.struct((-F.col("spread")).alias("s"), "at"))).alias("by"))
    axes = store(widest.select("size", F.col("by")[0]["at"].alias("first"), F.try_element_at("by", F.lit(2))["at"].alias("second")), "axes")
    at = lambda c: F.coalesce(F.try_element_at("numbers", F.col(c) + 1), F.lit(0))
    slim = named.join(axes, "size", "left").select("vec_id", "label", "size", at("first").alias("x"), at("second").alias("y"))
    placed = store(running_totals(slim, ["size", "label", "x", "vec_id"], {"place": "1"}), "placed")
    groups = store(placed.groupBy("size", "label").agg(F.min("place").alias("tribe"), F.count("*").alias("n")), "tribes")
    groups = groups.withColumnsRenamed({"size": "_size", "label": "_label"})
    per_page = F.greatest(F.lit(LEAF), F.expr(f"cast({page_numbers} div greatest(size, 1) as int)"))
    per_slab = (F.ceil(F.sqrt(F.ceil(F.col("n") / F.col("per_page")))) * F.col("per_page")).cast("long")
    slabs = placed.join(groups, (F.col("size") == F.col("_size")) & F.col("label").eqNullSafe(F.col("_label"))).withColumn("per_page", per_page)
    slabs = slabs.withColumn("slab", F.expr("place - tribe")).withColumn("per_slab", per_slab).withColumn("slab", F.expr("slab div per_slab"))
    tiled = running_totals(slabs.select("vec_id", "size", "tribe", "slab", "y", "per_page"), ["size", "tribe", "slab", "y", "vec_id"], {"place": "1"})
    tiled = store(tiled, "tiled")
    starts = store(tiled.groupBy("tribe", "slab").agg(F.min("place").alias("start")), "slabs")
    paged = tiled.join(starts, ["tribe", "slab"]).select("vec_id", "tribe", F.expr("place - (place - start) % per_page").alias("page"))
    full = named.select("vec_id", "size", "numbers").join(paged, "vec_id").select("vec_id", "tribe", "page", "size", "numbers")
    full = store(full.mapInArrow(_as_bytes, "vec_id long, tribe long, page long, size int, numbers binary"), "entries")
    trees = full.repartition("page").sortWithinPartitions("page").mapInArrow(
        _pack, "page long, tribe long, size int, low binary, high binary, ids binary, vectors binary"
    )
    pages = store(trees, "pages")
    count = pages.count()
    together = max(1, min(PAGES_PER_GROUP, count // (GROUPS_PER_CORE * pages.sparkSession.sparkContext.defaultParallelism)))
    return Index(full, pages, max(1, -(-count // together)))


def _wanted(same: bool):
    """Per block of anchors and of boxes: the pages that can hold a row inside one of the windows, by group."""

    def run(anchors: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        if not len(anchors) or not len(pages):
            return pd.DataFrame({"anchor_id": [], "grp": [], "pages": []})
        low, high = _matrix(pages["low"], "<i4"), _matrix(pages["high"], "<i4")
        lowest, highest = bounds(_matrix(anchors["numbers"], "<i4"), low, high)
        open_to = (anchors["tribe"].to_numpy()[:, None] == pages["tribe"].to_numpy()) == same
        meets = np.zeros(open_to.shape, dtype=bool)
        width = max(len(w) for w in anchors["lows"])
        for w in range(width):
            has = np.array([w < len(x) for x in anchors["lows"]])
            lows = np.array([x[w] if w < len(x) else 0 for x in anchors["lows"]], dtype=np.int64)
            highs = np.array([x[w] if w < len(x) else 0 for x in anchors["highs"]], dtype=np.int64)
            meets |= has[:, None] & (highest >= lows[:, None]) & (lowest <= highs[:, None])
        a, p = np.nonzero(open_to & meets)
        pairs = pd.DataFrame({"anchor_id": anchors["anchor_id"].to_numpy()[a], "grp": pages["grp"].to_numpy()[p], "pages": pages["page"].to_numpy()[p]})
        return pairs.groupby(["anchor_id", "grp"])["pages"].agg(list).reset_index() if len(pairs) else pairs.astype(object)

    return run


def _visit(k: int):
    """The pages of one group and the anchors of one block that want some of them: the k best of each
    anchor and window (anchor_id, low, high, vec_id, score)."""

    def run(anchors: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, ...]] = []
        of_size = dict(list(pages.groupby("size")))
        for size, asked in anchors.groupby("size"):
            held = of_size.get(size)
            if held is None:
                continue
            ids = [np.frombuffer(x, dtype="<i8") for x in held["ids"]]
            tree = Tree([(i, np.frombuffer(x, dtype="<i4").reshape(len(i), size)) for i, x in zip(ids, held["vectors"])])
            root_of = dict(zip(held["of"], tree.roots))
            vectors = _matrix(asked["numbers"], "<i4")
            lowest, highest = bounds(vectors, tree.low, tree.high)
            for i, (anchor, lows, highs, wanted) in enumerate(zip(asked["anchor_id"], asked["lows"], asked["highs"], asked["pages"])):
                windows = list(zip((int(x) for x in lows), (int(x) for x in highs)))
                found = tree.search(vectors[i], lowest[i].tolist(), highest[i].tolist(), windows, k, anchor, [root_of[p] for p in wanted])
                out += [(anchor, *window, vec_id, score) for window, best in zip(windows, found) for score, vec_id in best]
        return pd.DataFrame(out, columns=["anchor_id", "low", "high", "vec_id", "score"])

    return run


_FOUND = "anchor_id long, low long, high long, vec_id long, score long"


def _search(wants: DataFrame, index: Index, k: int) -> DataFrame:
    """The k best of each anchor, window and group of pages; `wants` has an anchor once for each group,
    with the `pages` of it that can matter.

    A group goes once to each block of anchors that wants it, so no page meets them all in one task.
    """
    blocks = wants.select(F.col("grp").alias("to"), F.col("block").alias("anchors")).distinct()
    pages = index.pages.select(F.col("page").alias("of"), index.group("page").alias("in"), "size", "ids", "vectors")
    pages = pages.join(blocks, F.col("in") == F.col("to"))
    return wants.groupBy("grp", "block").cogroup(pages.groupBy("to", "anchors")).applyInPandas(_visit(k), _FOUND)


def _pages_for(anchors: DataFrame, index: Index, same: bool) -> DataFrame:
    """`anchors`, once for each group with `pages` of the own label (`same`), or of others, that can matter."""
    sizes = index.pages.groupBy("size").agg(F.ceil(F.count("*") / PAGES_PER_BLOCK).cast("int").alias("pages"))
    blocks = store(sizes, "page-blocks")
    asked = anchors.join(blocks, "size").withColumn("pb", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
    anchor_blocks = store(anchors.groupBy("size").agg(F.collect_set("block").alias("blocks")), "anchor-blocks")
    boxes = index.pages.select("page", "tribe", "size", "low", "high").join(blocks, "size").join(anchor_blocks, "size")
    boxes = boxes.withColumn("pb", F.pmod(F.xxhash64("page"), F.col("pages")).cast("int")).withColumn("block", F.explode("blocks"))
    keys = ["size", "block", "pb"]
    boxes = boxes.select(*keys, "page", index.group("page").alias("grp"), "tribe", "low", "high")
    pairs = asked.groupBy(*keys).cogroup(boxes.groupBy(*keys)).applyInPandas(_wanted(same), "anchor_id long, grp int, pages array<long>")
    return store(pairs, "wanted").join(anchors, "anchor_id")


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    ranked = found.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY {', '.join(by)} ORDER BY score DESC, vec_id)"))
    return ranked.where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
    embedding: str = "embedding", label: Column | str = "label", key: str = "vec_id",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    `anchors` is a condition on the column `vec_id`. A negative's score lies between `least` and `most`
    hundredths of the positive's.
    """
    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).alias("label"),
        F.col(embedding).cast("array<double>").alias("v"),
    )
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    index = build(rows.select("vec_id", F.col("r.label").alias("label"), whole_numbers(F.col("r.v")).alias("numbers")))
    asked = index.rows.where(anchors).withColumnRenamed("vec_id", "anchor_id")
    n_blocks = max(1, -(-asked.count() // ANCHORS_PER_BLOCK))
    block = F.pmod(F.xxhash64("anchor_id"), F.lit(n_blocks)).cast("int").alias("block")
    asked = store(asked.select("anchor_id", "tribe", "page", "size", "numbers", block), "anchors")
    no_window = [F.array(F.lit(x).cast("long")) for x in (-(2**62), 2**62)]
    # The best of the anchor's own page are a floor for all other pages.
    at_home = asked.withColumns({"lows": no_window[0], "highs": no_window[1], "grp": index.group("page"), "pages": F.array("page")})
    home = _search(at_home, index, positives)
    home = store(home, "home").select("anchor_id", "vec_id", "score")
    floors = home.groupBy("anchor_id").agg(F.min("score").alias("floor"), F.count("*").alias("held"))
    floor = F.when(F.col("held") == positives, F.col("floor")).otherwise(F.lit(-(2**62)))
    onward = store(
        asked.join(floors, "anchor_id", "left").withColumns({"lows": F.array(F.coalesce(floor, F.lit(-(2**62)))), "highs": no_window[1]}),
        "onward",
    ).drop("floor", "held")
    others = _pages_for(onward.withColumnRenamed("page", "home"), index, True)
    others = others.withColumn("pages", F.array_remove("pages", F.col("home"))).where(F.size("pages") > 0).drop("home")
    near = store(_best(home.unionByName(_search(others, index, positives).drop("low", "high")), ["anchor_id"], positives), "positives")
    near = near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    near = near.withColumns({
        "low": F.expr(f"cast(-floor(-cast(positive_score as decimal(20, 0)) * {least} / 100) as long)"),
        "high": F.expr(f"cast(floor(cast(positive_score as decimal(20, 0)) * {most} / 100) as long)"),
    })
    near = store(near.where("low <= high"), "windows")
    # The windows of one anchor: equal scores of positives share one.
    windows = near.groupBy("anchor_id").agg(F.sort_array(F.collect_set(F.struct("low", "high"))).alias("windows"))
    asked = asked.drop("page").join(windows, "anchor_id").withColumns({"lows": F.col("windows.low"), "highs": F.col("windows.high")}).drop("windows")
    found = _search(_pages_for(store(asked, "asked"), index, False), index, negatives)
    best = near.join(store(found, "found"), ["anchor_id", "low", "high"])
    return _best(best, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
