"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Among all rates that give each source
its target number of words, those nearest in relative entropy to one copy of each document are
wanted, none above MOST_COPIES. Their dual is convex and has one multiplier per source: a document
of n words has the rate min(MOST_COPIES, exp(multiplier * n / scale)). Newton steps, kept inside a
shrinking bracket, solve all sources at once; each step is one aggregate over the table of classes
(source, size, documents), since documents of one source and size have one rate.

Rates are then rounded into whole copies: totals per class follow the running sum of the rates, and
what a source still lacks or has too much is made good with the largest class that fits, again and
again. Within a class the documents of the smallest hash of id, then of text, get the extra copies; of rows
equal in both as many as are due get one, whichever.

Sources are ordered by code point, null last, and weigh 5, 2, 1, 5, 2, 1, ... They share all words;
a target stops at MOST_COPIES times the words of its source and the excess goes to the others by
weight. Null texts have size 0 and documents without words one copy and nothing taken. A source that
is too small for its target in whole documents takes the nearest number. Rows that repeat an id, and rows
without one, are documents of their own. An empty table gives an empty result. Columns other than the three named are
only passed on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.operators.ordering import running_totals
from postloom.session import store

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
NEWTON_STEPS = 60
TOLERANCE = 1e-9
CORRECTIONS = 12
_FIXED = 1 << 20  # rates are summed as whole multiples of 1 / _FIXED
_WORDS = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, docs, squares and target, from rows (source, size, docs); stored.

    The table has one row per source; only two sums over it come to the driver.
    """
    sources = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("docs")).alias("source_size"),
        F.sum(F.col("size").cast("double") * F.col("size") * F.col("docs")).alias("squares"),
        F.sum("docs").alias("docs"),
    ).withColumn("unnamed", F.col("source").isNull())
    ranked = running_totals(sources, ["unnamed", "source"], {"place": "1"})
    picks = F.array(*[F.lit(w) for w in weights])
    table = store(ranked.withColumn("weight", F.element_at(picks, (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    # Sources at their limit leave the rest to the others; each round can only raise the level.
    level = 0.0
    while True:
        free = F.col("weight") * F.lit(level) < F.col("source_size") * most
        sums = table.agg(
            F.sum(F.when(~free, F.col("source_size") * most).otherwise(0)).alias("full"),
            F.sum(F.when(free, F.col("weight")).otherwise(0)).alias("shares"),
        ).first()
        if not sums["shares"]:
            break
        higher = (total - sums["full"]) / sums["shares"]
        if higher <= level:
            break
        level = higher
    target = F.least(F.col("weight") * F.lit(float(level)), (F.col("source_size") * most).cast("double"))
    return store(table.withColumn("target", target), "targets")


def _with(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], how: str = "left") -> DataFrame:
    """`left` with columns of `right`, matched on the keys, null equal to null."""
    right = right.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *columns)
    condition = F.lit(True)
    for k in keys:
        condition &= F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return left.join(right, condition, how).select(*left.columns, *columns)


def _rate(multiplier: Column, scale: Column, size: Column, most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(multiplier * size / scale, F.lit(50.0))))


def solve(classes: DataFrame, targets: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """The multiplier of each source by Newton's method on the dual; stored.

    A source whose target is its limit has no finite multiplier; a bound of the bracket stands for it.
    """
    # In this unit the slope of the words at multiplier 0 is the words of the source.
    state = targets.select(
        "source", "source_size", "target", F.greatest(F.col("squares") / F.greatest(F.col("source_size"), F.lit(1)), F.lit(1.0)).alias("scale"),
        F.lit(0.0).alias("multiplier"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(False).alias("done"),
    )
    state = store(state, "dual")
    for _ in range(NEWTON_STEPS):
        open_rows = _with(classes, state.where(~F.col("done")), ["source"], ["multiplier", "scale"], "inner")
        rate = _rate(F.col("multiplier"), F.col("scale"), F.col("size"), most)
        words = F.col("docs") * F.col("size") * rate
        sums = open_rows.groupBy("source").agg(
            F.sum(words).alias("words"),
            F.sum(F.when(rate < most, words * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope"),
        )
        joined = _with(state, sums, ["source"], ["words", "slope"])
        gap = F.col("words") - F.col("target")
        close = F.abs(gap) <= TOLERANCE * F.greatest(F.col("target"), F.lit(1.0))
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("multiplier") - gap / F.col("slope"))
        inside = newton.isNotNull() & (newton > low) & (newton < high)
        # Outside the bracket: halve it, on a doubling scale while one end is still far away.
        halved = F.when((high > 1e5) & (low > -1e5), F.greatest(F.abs(low) * 2, F.lit(1.0))).when(
            (low < -1e5) & (high < 1e5), -F.greatest(F.abs(high) * 2, F.lit(1.0))
        ).otherwise((low + high) / 2)
        stays = F.col("done") | F.col("words").isNull() | close
        state = store(
            joined.select(
                "source", "source_size", "target", "scale",
                F.when(stays, F.col("multiplier")).when(inside, newton).otherwise(halved).alias("multiplier"),
                F.when(stays, F.col("low")).otherwise(low).alias("low"),
                F.when(stays, F.col("high")).otherwise(high).alias("high"),
                (stays | (high - low < 1e-12)).alias("done"),
            ),
            "dual",
        )
        if state.where(~F.col("done")).isEmpty():
            break
    return state


def round_classes(classes: DataFrame, duals: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Whole copies of each class, near the rates in order of size and near the target in sum; stored."""
    rated = _with(classes, duals, ["source"], ["multiplier", "scale", "target"]).withColumn(
        "rate", _rate(F.col("multiplier"), F.col("scale"), F.col("size"), most)
    )
    rated = rated.withColumn("due", F.round(F.col("rate") * F.col("docs") * _FIXED).cast("long")).withColumn("unnamed", F.col("source").isNull())
    summed = running_totals(rated, ["unnamed", "source", "size"], {"before": "due"})
    whole = F.expr(f"(before + due + {_FIXED // 2}) div {_FIXED} - (before + {_FIXED // 2}) div {_FIXED}")
    copies = F.when(F.col("size") == 0, F.col("docs")).otherwise(F.least(whole, F.col("docs") * most))
    table = store(summed.select("source", "size", "docs", "rate", "target", copies.alias("copies")), "classes-rounded")
    for _ in range(CORRECTIONS):
        lacks = table.groupBy("source").agg(
            F.round(F.max("target") - F.sum(F.col("size") * F.col("copies"))).cast("long").alias("lack")
        )
        room = F.when(F.col("lack") > 0, F.col("docs") * most - F.col("copies")).otherwise(F.col("copies"))
        fitting = _with(table, lacks, ["source"], ["lack"]).where((F.col("size") > 0) & (F.col("size") <= F.abs("lack")) & (room > 0))
        moves = fitting.groupBy("source").agg(
            F.max(F.struct("size", F.least(room, F.floor(F.abs("lack") / F.col("size"))).alias("n"), "lack")).alias("move")
        ).select("source", "move.*").select("source", "size", (F.col("n") * F.signum("lack")).cast("long").alias("change"))
        moves = store(moves, "moves")
        if moves.isEmpty():
            break
        changed = _with(table, moves, ["source", "size"], ["change"])
        copies = F.col("copies") + F.coalesce("change", F.lit(0))
        table = store(changed.withColumn("copies", copies).drop("change"), "classes-rounded")
    return table


def plan_copies(slim: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> tuple[DataFrame, DataFrame]:
    """From stored rows (source, size, order, mark): targets per source; and per class its rate, the
    `base` copies of each document, and who gets one copy more: all rows before (last_order, last_mark)
    and the first `first_n` of the `equals` rows there."""
    classes = store(slim.groupBy("source", "size").agg(F.count("*").alias("docs")), "classes")
    targets = source_targets(classes, weights, most)
    rounded = round_classes(classes, solve(classes, targets, most), most).select(
        "source", "size", "docs", "rate",
        F.expr("copies div greatest(docs, 1)").alias("base"), F.expr("copies % greatest(docs, 1)").alias("extra"),
    )
    # The position of equal rows in their class, from positions in the order of all documents.
    # Stored apart from the aggregate, so that Spark can split the join at a class of many documents.
    some = store(_with(slim, rounded.where(F.col("extra") > 0), ["source", "size"], ["extra"], "inner"), "some")
    some = some.groupBy("source", "size", "order", "mark", "extra").agg(F.count("*").alias("equals"))
    placed = running_totals(some.withColumn("unnamed", F.col("source").isNull()), ["unnamed", "source", "size", "order", "mark"], {"place": "equals"})
    placed = store(placed, "positions")
    starts = placed.groupBy("source", "size").agg(F.min("place").alias("start"))
    left = _with(placed, starts, ["source", "size"], ["start"]).withColumn("first_n", F.expr("extra - (place - start)"))
    # One row per class: where its last extra copy goes. Stored apart from the next join by class, so that
    # Spark can split this one at a class of many documents.
    cuts = store(left.where("first_n > 0 AND first_n <= equals"), "cuts").withColumnsRenamed({"order": "last_order", "mark": "last_mark"})
    final = _with(rounded, cuts, ["source", "size"], ["last_order", "last_mark", "first_n", "equals"])
    return targets, store(final.select("source", "size", "rate", "base", "last_order", "last_mark", "first_n", "equals"), "copies")


_PLAN = ("rate", "base", "last_order", "last_mark", "first_n", "equals")


def _keyed(docs: DataFrame, text: str, source: str, key: str, prefix: str = "") -> DataFrame:
    """`docs` with what the plan goes by: source and size, and the order of a document in its class, by
    the hash of its id and then of its text."""
    return docs.withColumns({
        f"{prefix}source": F.col(source).cast("string"), f"{prefix}size": size_of(F.col(text)),
        f"{prefix}order": F.xxhash64(F.col(key), F.lit(11)), f"{prefix}mark": F.xxhash64(F.col(text), F.lit(13)),
    })


def _with_copies(planned: DataFrame, plan: DataFrame, prefix: str = "") -> DataFrame:
    """Add the column `copies` (with the prefix) to rows that have the plan's columns.

    Rows equal in id and text of which only some get a copy more are numbered, as stored; no other row is.
    """
    of = lambda c: F.col(f"{prefix}{c}")
    same = (of("order") == of("last_order")) & (of("mark") == of("last_mark"))
    before = (of("order") < of("last_order")) | ((of("order") == of("last_order")) & (of("mark") < of("last_mark")))
    undecided = F.coalesce(same & (of("first_n") < of("equals")), F.lit(False))
    more = F.coalesce((before | same).cast("int"), F.lit(0))
    decided = planned.withColumn(f"{prefix}copies", of("base") + more)
    if plan.where("first_n < equals").isEmpty():
        return decided
    tie, place = f"{prefix}tie", f"{prefix}place"
    tied = store(planned.where(undecided).withColumns({f"{prefix}unnamed": of("source").isNull(), tie: F.monotonically_increasing_id()}), "ties")
    tied = store(running_totals(tied, [f"{prefix}unnamed", f"{prefix}source", f"{prefix}size", tie], {place: "1"}), "numbered")
    starts = tied.groupBy(of("source").alias("_s"), of("size").alias("_n")).agg(F.min(place).alias("_start"))
    tied = tied.join(starts, of("source").eqNullSafe(F.col("_s")) & (of("size") == F.col("_n")))
    tied = tied.withColumn(f"{prefix}copies", of("base") + (F.col(place) - F.col("_start") < of("first_n")).cast("int"))
    return decided.where(~undecided).unionByName(tied.select(*decided.columns))


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and rate of every document."""
    named = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    slim = store(_keyed(named, "text", "source", "doc_id").drop("text"), "sizes")
    targets, plan = plan_copies(slim.drop("doc_id"))
    planned = _with_copies(_with(slim, plan, ["source", "size"], list(_PLAN)), plan)
    return _with(planned, targets, ["source"], ["source_size", "target"]).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate"
    )


def mixed(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """The documents themselves, each as often as the mix takes it; all columns as they were."""
    keyed = _keyed(docs, text, source, key, "_mix_")
    slim = store(keyed.select(*[F.col(f"_mix_{c}").alias(c) for c in ("source", "size", "order", "mark")]), "sizes")
    _, plan = plan_copies(slim)
    named = plan.select(F.col("source").alias("_mix_s"), F.col("size").alias("_mix_n"), *[F.col(c).alias(f"_mix_{c}") for c in _PLAN])
    found = keyed.join(named, keyed["_mix_source"].eqNullSafe(named["_mix_s"]) & (keyed["_mix_size"] == named["_mix_n"])).drop("_mix_s", "_mix_n")
    times = _with_copies(found, plan, "_mix_").where(F.col("_mix_copies") > 0)
    copies = times.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_copies").cast("long"))))
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])
