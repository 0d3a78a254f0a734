"""Connected components of a graph in Spark, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import few
from postloom.session import store


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (columns a, b of one type); stored.

    Nodes of one component, and no others, share a root. In each round every node moves to the
    neighbour, or itself, of the smallest random rank; the graph of the places moved to has about half
    the nodes. Rounds are few, each is three combining aggregates or joins, and each is stored, so a
    lost executor repeats one step only. Null ends and loops are ignored; repeated edges do no harm.
    """
    current = store(edges.where("a != b").select("a", "b").distinct(), "edges")
    moves: list[DataFrame] = []
    while rows := current.count():
        rank = lambda c: F.xxhash64(c, F.lit(len(moves)))  # noqa: B023, E731
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(F.struct(rank(F.col("b")).alias("rank"), F.col("b").alias("node"))).alias("best"))
        own = F.struct(rank(F.col("a")).alias("rank"), F.col("a").alias("node"))
        move = store(few(best.select(F.col("a").alias("node"), F.least("best", own)["node"].alias("to")), 2 * rows), "moves")
        moves.append(move)
        to_a = move.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        to_b = move.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        moved = current.join(to_a, "a").join(to_b, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        current = store(few(moved.where("a != b").distinct(), rows), "edges")
    if not moves:
        return store(current.select(F.col("a").alias("node"), F.col("b").alias("root")), "roots")
    found = moves[0].withColumnRenamed("to", "root")
    for move in moves[1:]:
        step = move.select(F.col("node").alias("root"), F.col("to"))
        found = found.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return store(few(found, moves[0].count()), "roots")
