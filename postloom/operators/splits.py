"""Activity tiers and the positional train / dev / test split."""

from __future__ import annotations

from functools import cached_property
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.operators.ordering import running_totals
from postloom.session import store

TIERS = (1, 2, 3, 4, 5)

# Orders a table can be split in: the columns that name a group of rows, and the order inside it.
# "reference": all positives by user and time, then all negatives. "user": all rows by user and time.
ORDERS = {
    "reference": (["block", "user_id"], ["created_at", "id"]),
    "user": (["user_id"], ["created_at", "block", "id"]),
}


def tier(rows: DataFrame, k: int) -> DataFrame:
    """Rows of users with more than `k` distinct posts."""
    return rows.where(f"content_num > {k}")


def clustered(rows: DataFrame, order: str = "reference") -> DataFrame:
    """Rows range-partitioned and sorted in the order of a split: stored like this, a filter on groups
    of rows skips most of the files and row groups.

    The bounds of the ranges run through a group, so one of any size is spread over as many files as
    its rows need.
    """
    by, inside = ORDERS[order]
    return rows.repartitionByRange(*by, *inside).sortWithinPartitions(*by, *inside)


class Cut(NamedTuple):
    """The group a position falls in, how many rows come before that group, and its size."""

    group: tuple[int, ...]
    before: int
    size: int

    @property
    def user(self) -> int:
        return self.group[-1]


def _compared(columns: list[str], sign: str, group: tuple[int, ...]) -> str:
    """SQL: a row's group compared with a fixed one, column by column."""
    choices = []
    for i, (c, value) in enumerate(zip(columns, group)):
        same = [f"{o} = {v}" for o, v in zip(columns[:i], group)]
        choices.append(" AND ".join([*same, f"{c} {sign} {value}"]))
    return "(" + " OR ".join(f"({c})" for c in choices) + ")"


def _group(columns: list[str], group: tuple[int, ...]) -> str:
    """SQL: whether a row is of a group."""
    return "(" + " AND ".join(f"{c} = {v}" for c, v in zip(columns, group)) + ")"


class Splits:
    """Train, dev and test parts of each tier of `rows`, a stored table with `content_num`.

    The parts are cut by position: the first int(0.8 n) rows, the next int(0.1 n), the rest. Then
    train loses all rows of the user in its last row, dev and test all rows of the user in their
    first row. A position is found through running totals over one row per user, not over the rows;
    the parts are then plain filters on the stored table. Only dev can end inside a user, so only
    the rows of such users, one per tier, are put in order. An empty part stays empty.
    """

    def __init__(self, rows: DataFrame, order: str = "reference", tiers: tuple[int, ...] = TIERS):
        self.rows, self.tiers = rows, tiers
        self.by, self.inside = ORDERS[order]
        sizes = rows.groupBy(*self.by).agg(F.count("*").alias("n"), F.max("content_num").alias("content_num"))
        weights = {f"before_{k}": f"CASE WHEN content_num > {k} THEN n ELSE 0 END" for k in tiers}
        self.groups = store(running_totals(sizes, self.by, weights), "split-groups")
        self._find_cuts()

    def _find_cuts(self) -> None:
        totals = self.groups.agg(
            *[F.expr(f"coalesce(sum(n) FILTER (WHERE content_num > {k}), 0)").alias(f"n_{k}") for k in self.tiers]
        ).first()
        self.ends, wanted = {}, []
        for k in self.tiers:
            n = totals[f"n_{k}"]
            train, dev = int(n * 0.8), int(n * 0.1)
            self.ends[k] = (train, train + dev, n)
            wanted += [(k, position) for position in (train - 1, train, train + dev)]
        # Three positions per tier, each inside one group: 15 rows at most.
        hits = self.groups.where(
            " OR ".join(
                f"(content_num > {k} AND before_{k} <= {at} AND before_{k} + n > {at})" for k, at in wanted
            )
        ).collect()
        self.cuts = {
            (k, at): Cut(tuple(row[c] for c in self.by), row[f"before_{k}"], row["n"])
            for k, at in wanted
            for row in hits
            if row["content_num"] > k and row[f"before_{k}"] <= at < row[f"before_{k}"] + row["n"]
        }

    def _train(self, k: int) -> str:
        """SQL: whether a row of tier `k` is in train."""
        last = self.cuts.get((k, self.ends[k][0] - 1))
        return "false" if last is None else f"({_compared(self.by, '<', last.group)} AND user_id <> {last.user})"

    def _dev(self, k: int) -> tuple[str, Cut | None, int]:
        """SQL: whether a row of tier `k` is in dev with its whole group; the group dev ends in, and how
        many of its first rows are in dev."""
        start, end, _ = self.ends[k]
        first, after = self.cuts.get((k, start)), self.cuts.get((k, end))
        if first is None or after is None or start == end:
            return "false", None, 0
        whole = f"({_compared(self.by, '>', first.group)} AND user_id <> {first.user} AND {_compared(self.by, '<', after.group)})"
        left = end - after.before
        return whole, after if left and after.user != first.user else None, left

    @cached_property
    def _cut_rows(self) -> DataFrame | None:
        """The rows of the groups that dev ends in, with their `position` in the group; None without any."""
        groups = {after.group for _, after, _ in map(self._dev, self.tiers) if after}
        if not groups:
            return None
        rows = self.rows.where(" OR ".join(_group(self.by, g) for g in sorted(groups)))
        # Rows of one log id differ in what they were joined with: any fixed order of these will do.
        rest = F.xxhash64(*[c for c in rows.columns if c not in (*self.by, *self.inside)])
        order = [*self.by, *self.inside, "rest"]
        placed = running_totals(rows.withColumn("rest", rest), order, {"place": "1"})
        starts = placed.groupBy(*self.by).agg(F.min("place").alias("start"))
        return store(placed.join(starts, self.by).selectExpr(*rows.columns, "place - start AS position"), "cut-rows")

    def placed(self) -> DataFrame:
        """The rows with `places`, the train and dev parts they are in: structs of tier `k` and `part`.

        The rows of a group that dev ends in come a second time, with the places that their position
        gives them and `whole` false.
        """
        choices, cuts = [], []
        for k in self.tiers:
            dev, after, left = self._dev(k)
            choices.append(
                f"CASE WHEN content_num > {k} AND {self._train(k)} THEN struct({k} AS k, 'train' AS part)"
                f" WHEN content_num > {k} AND {dev} THEN struct({k} AS k, 'dev' AS part) END"
            )
            if after:
                inside = f"content_num > {k} AND {_group(self.by, after.group)} AND position < {left}"
                cuts.append(f"CASE WHEN {inside} THEN struct({k} AS k, 'dev' AS part) END")

        def chosen(rows: DataFrame, cases: list[str], whole: str) -> DataFrame:
            return rows.selectExpr(*self.rows.columns, f"filter(array({', '.join(cases)}), x -> x IS NOT NULL) AS places", f"{whole} AS whole")

        found = chosen(self.rows, choices, "true")
        return found.unionByName(chosen(self._cut_rows, cuts, "false")) if cuts else found

    def parts(self) -> DataFrame:
        """Train and dev of all tiers: the rows with tier `k` and `part`, from one pass over the rows."""
        return self.placed().selectExpr(*self.rows.columns, "inline(places)")

    def train(self, k: int) -> DataFrame:
        return tier(self.rows, k).where(self._train(k))

    def dev(self, k: int) -> DataFrame:
        whole, after, left = self._dev(k)
        rows = tier(self.rows, k).where(whole)
        if after is None:
            return rows
        cut = self._cut_rows.where(f"{_group(self.by, after.group)} AND content_num > {k} AND position < {left}")
        return rows.unionByName(cut.drop("position"))

    def test_users(self) -> DataFrame:
        """The users of the test part of each tier: `k` and user_id, each once."""
        choices = []
        for k in self.tiers:
            start = self.cuts.get((k, self.ends[k][1]))
            if start is not None:
                inside = f"content_num > {k} AND {_compared(self.by, '>', start.group)} AND user_id <> {start.user}"
                choices.append(f"CASE WHEN {inside} THEN {k} END")
        if not choices:
            return self.groups.selectExpr("0 AS k", "user_id").where("false")
        tiers = f"explode(filter(array({', '.join(choices)}), x -> x IS NOT NULL)) AS k"
        return self.groups.selectExpr("user_id", tiers).select("k", "user_id").distinct()

    def tests(self, lists: DataFrame) -> DataFrame:
        """The test parts as ground truth: `k`, and each user with the list of posts."""
        return self.test_users().join(lists.select("user_id", "content_list"), "user_id", "left")

    def test_pieces(self, pieces: DataFrame) -> DataFrame:
        """The same from lists in pieces: `k`, user_id, part, content_list and num; no whole list is made.

        A user without posts has one row without a piece.
        """
        return self.test_users().join(pieces, "user_id", "left").select("k", "user_id", "part", "content_list", "num")

    def test(self, k: int, lists: DataFrame) -> DataFrame:
        return self.tests(lists).where(F.col("k") == k).drop("k")
