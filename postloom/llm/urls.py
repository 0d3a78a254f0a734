"""URL filter: host rules, and character models for the URLs that no rule covers.

Two variable-order Markov models, one of accepted and one of blocked URLs, give the probability of
each character from up to ORDER characters before it. A character's estimate interpolates all
orders, each in proportion to how often its context was seen (Witten-Bell smoothing), down to a
uniform distribution. The verdict follows the difference of the two log-likelihoods per character:
URLs over the calibrated threshold are allowed.

The models count the contexts of all different URLs that a rule decides, in Spark, but for a quarter of
them that is held back: all of it calibrates the threshold by balanced accuracy. The contexts that are
seen most are held in memory where URLs are scored. All others stay a table: a character whose context
may go on there is left open, and a join with that table closes it, once for all URLs it stands in.
Counting and scoring take time in proportion to a URL's length, whatever it is.

A null URL, or one without "://", has an empty host and path and no rule; the method judges its
text (an empty one is allowed when the threshold is not above 0). Without URLs of both verdicts to
learn from, the method allows. Repeated rows get the same verdict; further columns do not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.operators.ordering import range_parts
from postloom.session import store

Rule = tuple[str, str, str]  # verdict, host, path

# The rules of the query.
RULES: tuple[Rule, ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 5
# The scores of up to so many held back URLs are ranked on the driver, those of more in Spark.
SAMPLED_URLS = 4_096
# Contexts seen less often are left to the shorter ones.
LEAST_SEEN = 2
# Of the others, those seen once or more in so many characters are held in memory.
MOST_CONTEXTS = 50_000
# Characters taken at a time, and different runs held, when contexts are counted.
_STRETCH, _HELD = 1 << 16, 1 << 18
# URLs that a task counts or scores: they are few bytes, but much work.
_PER_TASK = 2_000
# The uniform distribution below all orders spreads over the code points of Unicode.
ALPHABET = 1_114_112
_START, _END = "\x02", "\x03"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without "://"."""
    begins = F.instr(url, "://")
    rest = F.substring(url, begins + 3, F.length(url))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    known = F.coalesce(begins > 0, F.lit(False))
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(known, lower).otherwise(""), F.when(known, path).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text and verdict; null when none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decided, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, decided).otherwise(verdict)
    return rule, verdict


@dataclass
class CharacterModel:
    """Counts of characters after each context, and what the smoothing needs of a context."""

    after: dict[str, dict[str, int]]

    def __post_init__(self) -> None:
        # Of each context: the times it was seen and the share that goes to the next shorter one.
        self.weight = {c: (n := sum(f.values()), len(f) / (n + len(f))) for c, f in self.after.items()}

    def chance(self, marked: str, at: int) -> tuple[float, int]:
        """Of the character at a place, and the length of the first context before it that is not here."""
        chance, char = 1 / ALPHABET, marked[at]
        for length in range(min(ORDER, at) + 1):
            context = marked[at - length : at]
            if context not in self.weight:
                return chance, length  # longer contexts are not there either
            seen, back = self.weight[context]
            chance = back * chance + (1 - back) * self.after[context].get(char, 0) / seen
        return chance, min(ORDER, at) + 1

    def log_likelihood(self, text: str) -> float:
        """Of the text and its end, from its start."""
        marked = _START + text + _END
        return sum(math.log(self.chance(marked, at)[0]) for at in range(1, len(marked)))


@dataclass
class UrlModel:
    allowed: CharacterModel
    blocked: CharacterModel
    threshold: float = 0.0
    # The contexts that are not held here: verdict, context, seen, after. None if all are.
    rest: DataFrame | None = None

    def difference(self, url: str | None) -> float:
        """Log-likelihood ratio of allowed to blocked per character, by the contexts held here."""
        text = url or ""
        return (self.allowed.log_likelihood(text) - self.blocked.log_likelihood(text)) / (len(text) + 1)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per verdict how often each run of up to ORDER + 1 characters occurs: a context and what follows it."""

    def counted(counts: Counter[tuple[str, str]]) -> pa.RecordBatch:
        verdicts, runs = zip(*counts) if counts else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(verdicts, pa.string()), pa.array([r[:-1] for r in runs], pa.string()), pa.array([r[-1] for r in runs], pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["verdict", "context", "char", "n"],
        )

    counts: Counter[tuple[str, str]] = Counter()
    for batch in batches:
        for verdict, url in zip(batch.column("verdict").to_pylist(), batch.column("url").to_pylist()):
            marked = _START + url + _END
            for start in range(0, len(marked), _STRETCH):
                for n in range(ORDER + 1):  # the first character has none before it and is never predicted
                    first, last = max(start, 1 if n == 0 else 0), min(start + _STRETCH, len(marked) - n)
                    counts.update((verdict, marked[i : i + n + 1]) for i in range(first, last))
                if len(counts) > _HELD:
                    yield counted(counts)
                    counts.clear()
    yield counted(counts)


def _spread(stored: DataFrame) -> DataFrame:
    return stored.repartition(max(1, -(-stored.count() // _PER_TASK)))


class Contexts(dict[str, dict[str, dict[str, int]]]):
    """By verdict and context the characters that follow; `rest` is the table of the contexts not held here."""

    rest: DataFrame | None = None


def _count_contexts(urls: DataFrame) -> Contexts:
    """The characters that follow each context, counted over all given URLs.

    Contexts seen less than LEAST_SEEN times are left to the shorter ones. Those seen less than once in
    MOST_CONTEXTS of a verdict's characters stay in Spark: so at most MOST_CONTEXTS of each length come to
    the driver. A context has at most ALPHABET characters that follow it.
    """
    counts = _spread(urls.select("verdict", "url")).mapInArrow(_contexts, "verdict string, context string, char string, n long")
    counts = counts.groupBy("verdict", "context", "char").agg(F.sum("n").alias("n"))
    after = F.map_from_entries(F.collect_list(F.struct("char", "n"))).alias("after")
    contexts = counts.groupBy("verdict", "context").agg(F.sum("n").alias("seen"), after)
    contexts = store(contexts.where((F.col("context") == "") | (F.col("seen") >= LEAST_SEEN)), "contexts")
    # The sum of the empty context is that of all characters.
    totals = {r["verdict"]: r["seen"] for r in contexts.where("context = ''").select("verdict", "seen").collect()}
    found = Contexts()
    if not totals:
        return found
    least = F.create_map(*[x for v, n in totals.items() for x in (F.lit(v), F.lit(n / MOST_CONTEXTS))])
    held = (F.col("context") == "") | (F.col("seen") >= least[F.col("verdict")])
    for row in contexts.where(held).select("verdict", "context", "after").toArrow().to_pylist():
        found.setdefault(row["verdict"], {})[row["context"]] = dict(row["after"])
    rest = contexts.where(~held)
    if not rest.isEmpty():
        found.rest = rest
    return found


def learn(ruled: DataFrame) -> UrlModel | None:
    """Models and threshold from URLs with a verdict (columns url, verdict); None without both verdicts.

    Three quarters of all different URLs are counted; all the others set the threshold.
    """
    known = store(ruled.where(F.col("verdict").isNotNull() & F.col("url").isNotNull()).select("url", "verdict").distinct(), "ruled")
    held = F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(4)) == 0
    counts = _count_contexts(known.where(~held))
    if set(counts) != {"allow", "block"}:
        return None
    model = UrlModel(CharacterModel(counts["allow"]), CharacterModel(counts["block"]), rest=counts.rest)
    scored = with_difference(known.where(held), model).select("difference", (F.col("verdict") == "allow").alias("allowed"))
    model.threshold = threshold(store(scored, "held-scores"))
    return model


def threshold(scored: DataFrame) -> float:
    """What `calibrate` finds, for a stored table of any size (columns difference, allowed)."""
    if scored.count() <= SAMPLED_URLS:
        return calibrate([tuple(row) for row in scored.collect()])
    sums = scored.groupBy("difference").agg(F.count_if("allowed").alias("good"), F.count_if(~F.col("allowed")).alias("bad"))
    parts = store(range_parts(sums, ["difference"]), "url-scores")
    allowed, blocked = parts.agg(F.sum("good"), F.sum("bad")).first()
    if not allowed or not blocked:
        return 0.0
    # What comes before a part, in one row per part, and before a score in its part.
    ends = parts.groupBy("part").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("difference").alias("last"))
    earlier = "ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    ends = ends.selectExpr("part", *[f"{f} OVER ({earlier}) AS {n}" for f, n in (("sum(good)", "good_end"), ("sum(bad)", "bad_end"), ("max(last)", "last_end"))])
    in_part = "PARTITION BY part ORDER BY difference"
    before = f"{in_part} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    cuts = parts.join(F.broadcast(ends), "part").selectExpr(
        f"coalesce(good_end, 0) + coalesce(sum(good) OVER ({before}), 0) AS good",
        f"coalesce(bad_end, 0) + coalesce(sum(bad) OVER ({before}), 0) AS bad",
        f"0.5D * (coalesce(lag(difference) OVER ({in_part}), last_end) + difference) AS cut",
    )
    right = (F.lit(allowed) - F.col("good")) / F.lit(allowed) + F.col("bad") / F.lit(blocked)
    best = cuts.where("cut IS NOT NULL").select(right.alias("right"), (-F.abs("cut")).alias("near"), (-F.col("cut")).alias("low"))
    found = best.agg(F.max(F.struct("right", "near", "low")).alias("best")).first()["best"]
    return -found["low"] if found else 0.0


def calibrate(scored: list[tuple[float, bool]]) -> float:
    """The threshold of the best balanced accuracy; among equals the one nearest to 0."""
    allowed = sum(good for _, good in scored)
    blocked = len(scored) - allowed
    if not allowed or not blocked:
        return 0.0
    scores = sorted(scored)
    # A cut between two neighbours allows all above it.
    cuts = [(0.5 * (a[0] + b[0]), i + 1) for i, (a, b) in enumerate(zip(scores, scores[1:])) if a[0] < b[0]]
    below = [0]
    for _, good in scores:
        below.append(below[-1] + good)

    def quality(cut: tuple[float, int]) -> tuple[float, float]:
        _, i = cut
        right = (allowed - below[i]) / allowed + (i - below[i]) / blocked
        return right, -abs(cut[0])

    return max(cuts, key=quality)[0] if cuts else 0.0


def _sums(model: UrlModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per URL, a row without a run: the log-likelihood ratio of its characters that memory decides. Per URL,
    verdict and run of characters that longer contexts may go on with: how often it is there, its last
    character's chance so far and the length of the first context that is not in memory."""
    sides = (("allow", model.allowed, 1), ("block", model.blocked, -1))

    def told(rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"id": pa.int64(), "verdict": pa.string(), "run": pa.string(), "length": pa.int32(), "chance": pa.float64(), "n": pa.int64()}
        columns = zip(*rows) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for key, url in zip(batch.column("id").to_pylist(), batch.column("url").to_pylist()):
                marked = _START + url + _END
                for start in range(1, len(marked), _STRETCH):
                    total, left = 0.0, Counter()
                    for at in range(start, min(start + _STRETCH, len(marked))):
                        for verdict, side, sign in sides:
                            chance, length = side.chance(marked, at)
                            if length > min(ORDER, at):
                                total += sign * math.log(chance)
                            else:
                                left[verdict, marked[max(0, at - ORDER) : at + 1], length, chance] += 1
                    out.append((key, None, None, None, total, 1))
                    out.extend((key, *found, n) for found, n in left.items())
                    if len(out) >= _STRETCH:
                        yield told(out)
                        out.clear()
            yield told(out)
            out.clear()

    return run


def with_difference(rows: DataFrame, model: UrlModel | None) -> DataFrame:
    """`rows` (a column url, no nulls, each once) with `difference`, the log-likelihood ratio of allowed to
    blocked per character; 0 without a model."""
    if model is None:
        return rows.withColumn("difference", F.lit(0.0))
    if model.rest is None:
        held = UrlModel(model.allowed, model.blocked)

        @F.pandas_udf("double")
        def difference(urls: pd.Series) -> pd.Series:
            return pd.Series([held.difference(url) for url in urls], index=urls.index, dtype="float64")

        return _spread(store(rows, "url-texts")).withColumn("difference", difference("url"))
    numbered = store(rows.withColumn("id", F.monotonically_increasing_id()), "url-texts")
    sums = _spread(numbered.select("id", "url")).mapInArrow(_sums(UrlModel(model.allowed, model.blocked)), "id long, verdict string, run string, length int, chance double, n long")
    sums = store(sums, "url-sums")
    # Each different run is closed once: the contexts from the first that is not in memory to the longest.
    runs = sums.where("run IS NOT NULL").groupBy("verdict", "run").agg(F.first("length").alias("length"), F.first("chance").alias("chance"))
    longer = runs.select("*", F.explode(F.sequence("length", F.length("run") - 1)).alias("l")).selectExpr(
        "*", "substring(run, length(run) - l, l) AS context", "substring(run, length(run), 1) AS char"
    )
    steps = longer.join(model.rest, ["verdict", "context"]).groupBy("verdict", "run").agg(
        F.first("chance").alias("chance"),
        F.expr("sort_array(collect_list(struct(l, seen, size(after) / (seen + size(after)) AS back, coalesce(after[char], 0L) AS n)))").alias("steps"),
    )
    closed = steps.selectExpr("verdict", "run", "aggregate(steps, chance, (p, s) -> s.back * p + (1 - s.back) * s.n / s.seen) AS closed")
    # Stored, so that Spark can split the rows of a run that many URLs have.
    closed = store(closed, "closed-runs")
    # Sums of decimals do not depend on their order.
    log = F.when(F.col("run").isNull(), F.col("chance")).otherwise(F.log(F.coalesce("closed", "chance")) * F.col("n"))
    signed = F.when(F.col("verdict") == "block", -log).otherwise(log).cast("decimal(28,15)")
    total = sums.join(closed, ["verdict", "run"], "left").groupBy("id").agg(F.sum(signed).cast("double").alias("total"))
    return numbered.join(total, "id").withColumn("difference", F.col("total") / (F.length("url") + 1)).drop("id", "total")


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", key: str = "page_id") -> DataFrame:
    """page_id, host, path, rule, verdict and the method's score (null where a rule decides)."""
    host, path = split_url(F.col("url"))
    parts = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url")).withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumns({"rule": rule, "verdict": verdict})
    model = learn(ruled.select("url", "verdict"))
    # Each different text that no rule decides is scored once.
    unruled = ruled.where(F.col("rule").isNull()).withColumn("text", F.coalesce("url", F.lit("")))
    texts = with_difference(unruled.select(F.col("text").alias("url")).distinct(), model)
    scores = store(texts.select(F.col("url").alias("text"), (F.col("difference") - (model.threshold if model else 0.0)).alias("score")), "url-scores")
    judged = unruled.join(scores, "text").withColumn("verdict", F.when(F.col("score") >= 0, "allow").otherwise("block"))
    columns = ["page_id", "host", "path", "rule", "verdict", "score"]
    decided = ruled.where(F.col("rule").isNotNull()).withColumn("score", F.lit(None).cast("double"))
    return decided.select(*columns).unionByName(judged.select(*columns))
