"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer turns words into symbols: insults with a weight, threats, targets (who is spoken
to or of), negations and words of reported speech. Insults are learned: a trie holds in how many toxic
and other documents its words and prefixes occur, and a word's chance of marking a toxic document is
that of its longest known prefix, moved by its own counts. Four transducers then read the symbols of a
clause: a negation reaches the next words, reported speech the rest of the clause, quotation marks what
is between them, a target lends weight to insults near it, and a threat counts only with a target. They are
composed into one machine. Clauses it matches, not words by themselves, make the features of a
document: the heaviest clause of each kind, and the weight of all. A logistic model over these, drawn
toward the grammar's own weights, gives the score.

Learned from at most SAMPLED labelled documents of each class, whole texts, never from held-out ones;
counts leave out the document itself when the model is fitted. Labels other than 1 count as not toxic, a
null label is none. Null and empty texts score as documents without any match; texts of any length are
read whole; repeated rows score alike; without a labelled document of each class only the grammar and
its own weights speak. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import doc_fold, hash_sample
from postloom.session import store

SAMPLED = 3_000  # labelled documents of each class
SHORTEST, LONGEST = 4, 8  # characters of a prefix in the trie
PRIOR = 4.0  # how many documents a prefix is worth for the words that begin with it
LEAST_CHANCE = 0.6  # of marking a toxic document, for an insult
THRESHOLD = 0.7
REACH = 3  # words after a negation, or between target and insult
MOST_WEIGHT = 12.0
_LONG = 1 << 20  # texts beyond this are read word by word, not as a list

# Words of the grammar in English, German, French and Spanish.
TARGETS = """you your you're he she they him her them this these those
    du dich dir dein ihr euch er sie diese dieser tu toi te vous il elle ils elles ce cette tú ti usted ustedes él ella ellos ellas este esta""".split()
NEGATIONS = """not no never neither nor isn don doesn aren wasn won without
    nicht kein keine keinen nie niemals ohne pas jamais aucun aucune sans nunca jamás ningún ninguna sin""".split()
REPORTS = """said says say saying wrote writes claimed claims called calls alleged quoted reported according
    sagte sagt schrieb behauptete nannte angeblich laut dit disait écrit prétend selon dijo dice escribió según llamó""".split()
THREATS = """kill hurt destroy beat shoot stab burn hang punish murder
    töten umbringen schlagen zerstören tuer frapper détruire brûler matar golpear destruir quemar""".split()

SYMBOLS = ("other", "insult", "threat", "target", "not", "said", "quote", "end")
KINDS = ("plain", "targeted", "negated", "reported", "threat")
# What the grammar itself holds of a clause of each kind, of all clauses, and of length.
OWN_WEIGHTS = np.array([-3.0, 0.8, 1.0, 0.2, 0.2, 1.0, 0.5, 0.0])
_TOKENS = re.compile(r"[^\W_]+|[.;!?\n]+|[\"“”«»]")


@dataclass
class Transducer:
    """Arcs (state, symbol) -> (state, symbol out, weight); what is not listed passes through unchanged."""

    arcs: dict[tuple[int, str], tuple[int, str, float]] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.arcs.get((state, symbol), (state, symbol, 0.0))


def compose(first: Transducer, second: Transducer, symbols: Iterable[str] = SYMBOLS) -> Transducer:
    """The transducer that does first and then second, over the reachable pairs of states."""
    numbers, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        pair = todo.pop()
        for symbol in symbols:
            a, between, weight = first.step(pair[0], symbol)
            b, out, more = second.step(pair[1], between)
            if (a, b) not in numbers:
                numbers[a, b] = len(numbers)
                todo.append((a, b))
            arcs[numbers[pair], symbol] = (numbers[a, b], out, weight + more)
    return Transducer(arcs)


def _matches(symbol: str) -> bool:
    return symbol.startswith(("insult", "threat"))


def _variants(*marks: str) -> list[str]:
    found = list(SYMBOLS)
    for mark in marks:
        found += [f"{s}+{mark}" for s in found if _matches(s)]
    return found


def negation() -> Transducer:
    """A negation marks the matches among the next REACH words of its clause."""
    arcs: dict = {}
    for state in range(REACH + 1):
        for symbol in SYMBOLS:
            out = f"{symbol}+negated" if state and _matches(symbol) else symbol
            arcs[state, symbol] = (REACH if symbol == "not" else 0 if symbol == "end" else max(state - 1, 0), out, -1.0 if out != symbol else 0.0)
    return Transducer(arcs)


def reported() -> Transducer:
    """Words of reported speech mark the rest of the clause (state 1), quotation marks what is between
    them in the clause (state 2)."""
    arcs: dict = {}
    for state in range(3):
        for symbol in _variants("negated"):
            after = {"said": max(state, 1), "quote": 0 if state == 2 else 2, "end": 0}.get(symbol, state)
            marked = state and _matches(symbol)
            arcs[state, symbol] = (after, f"{symbol}+reported" if marked else symbol, -1.0 if marked else 0.0)
    return Transducer(arcs)


def targets() -> Transducer:
    """A target up to REACH words before a match, or up to REACH words after it, lends it weight.

    States count the words since the last target (1 to REACH + 1) or since the last match (beyond).
    """
    arcs: dict = {}
    near = REACH + 1
    for state in range(2 * near + 1):
        after_target, after_match = 1 <= state <= near, state > near
        for symbol in _variants("negated", "reported"):
            older = state + 1 if state and state not in (near, 2 * near) else 0
            if _matches(symbol):
                arcs[state, symbol] = (near + 1, f"{symbol}+targeted" if after_target else symbol, 1.0 if after_target else 0.0)
            elif symbol == "target":
                arcs[state, symbol] = (1, "late" if after_match else symbol, 1.0 if after_match else 0.0)
            elif symbol == "end":
                arcs[state, symbol] = (0, symbol, 0.0)
            elif symbol == "quote":
                arcs[state, symbol] = (state, symbol, 0.0)
            else:
                arcs[state, symbol] = (older, symbol, 0.0)
    return Transducer(arcs)


class Grammar:
    """The composed machine as tables, and the features of a text's symbols."""

    def __init__(self) -> None:
        machine = compose(compose(negation(), reported()), targets())
        states = 1 + max(s for s, _ in machine.arcs)
        self.next = [[machine.arcs[s, x][0] for x in SYMBOLS] for s in range(states)]
        self.out = [[machine.arcs[s, x][1] for x in SYMBOLS] for s in range(states)]
        self.weight = [[machine.arcs[s, x][2] for x in SYMBOLS] for s in range(states)]

    @staticmethod
    def kind(marks: str, late: bool) -> int | None:
        """The kind of clause that a marked symbol makes."""
        for i, mark in ((3, "+reported"), (2, "+negated")):
            if mark in marks:
                return i
        targeted = late or "+targeted" in marks
        if marks.startswith("threat"):
            return 4 if targeted else None
        return 1 if targeted else 0

    def features(self, symbols: Iterable[tuple[int, float]]) -> np.ndarray:
        """From (symbol, weight) of each token: 1, the heaviest clause of each kind, the logs of one more
        than the weight of all clauses, and of one more than the words where there is a match."""
        end = SYMBOLS.index("end")
        best = [0.0] * len(KINDS)
        words = state = 0
        total = 0.0
        held: list[tuple[str, float]] = []  # matches of this clause
        late = 0.0

        def close() -> float:
            found: dict[int, list[float]] = {}
            for marks, weight in held:
                kind = self.kind(marks, late > 0)
                if kind is not None:
                    found.setdefault(kind, []).append(weight)
            # The heaviest match counts whole, further ones add to it less and less.
            sums = {k: min(max(x) + math.log1p(sum(x) - max(x)) + late, MOST_WEIGHT) for k, x in found.items()}
            for kind, total in sums.items():
                best[kind] = max(best[kind], total)
            return max(sums.values(), default=0.0)

        for symbol, weight in symbols:
            out, more = self.out[state][symbol], self.weight[state][symbol]
            state = self.next[state][symbol]
            if symbol == end:
                if held:
                    total += close()
                held, late = [], 0.0
                continue
            words += 1
            if weight:
                held.append((out, max(weight + more, 0.0)))
            elif out == "late":
                late = more
        if held:
            total += close()
        return np.array([1.0, *best, math.log1p(total), math.log1p(words) if total else 0.0])


class Lexicon(dict):
    """Word -> (symbol, weight); words it has not met are looked up in the trie and remembered."""

    def __init__(self, trie: dict[str, tuple[float, float]], base: float):
        super().__init__()
        self.trie, self.base = trie, base
        self.fixed = {w: (SYMBOLS.index(s), 4.0 if s == "threat" else 0.0) for s, ws in (("target", TARGETS), ("not", NEGATIONS), ("said", REPORTS), ("threat", THREATS)) for w in ws}

    def chance(self, word: str, without: tuple[float, float] = (0.0, 0.0)) -> float:
        """The chance that a document with this word is toxic, `without` documents taken out of the counts."""
        p = self.base
        for entry in [*(word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1)), word + "$"]:
            if counts := self.trie.get(entry):
                other, toxic = max(counts[0] - without[0], 0.0), max(counts[1] - without[1], 0.0)
                p = (toxic + PRIOR * p) / (other + toxic + PRIOR)
        return p

    def read(self, word: str, without: tuple[float, float] = (0.0, 0.0)) -> tuple[int, float]:
        if word in self.fixed:
            return self.fixed[word]
        if not word[0].isalnum():
            return (SYMBOLS.index("end") if word[0] in ".;!?\n" else SYMBOLS.index("quote")), 0.0
        p = self.chance(word, without)
        if p < LEAST_CHANCE:
            return 0, 0.0
        return 1, math.log(p / (1 - p)) - math.log(self.base / (1 - self.base)) if p < 1 else MOST_WEIGHT

    def __missing__(self, word: str) -> tuple[int, float]:
        if len(self) > 500_000:
            self.clear()
        found = self[word] = self.read(word)
        return found


def tokens(text: str) -> Iterable[str]:
    """Words, clause ends and quotation marks in lower case."""
    text = text.lower()
    return _TOKENS.findall(text) if len(text) < _LONG else (m.group() for m in _TOKENS.finditer(text))


@dataclass
class Model:
    trie: dict[str, tuple[float, float]]
    base: float
    weights: np.ndarray

    def scorer(self):
        """A function from a text to its score."""
        lexicon, grammar = Lexicon(self.trie, self.base), Grammar()
        plain = float(self.weights[0])
        matching = {SYMBOLS.index("insult"), SYMBOLS.index("threat")}

        def score(text: str | None) -> float:
            total = plain
            if text:
                symbols = [lexicon[t] for t in tokens(text)]
                if any(s in matching for s, _ in symbols):
                    total = float(grammar.features(symbols) @ self.weights)
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))

        return score


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words, ended by "$", and prefixes of each document, with its label."""
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = {t for t in tokens(text or "") if t[0].isalnum()}
            found = {w + "$" for w in words} | {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string()), pa.array([toxic] * len(found), pa.int32())], names=["entry", "toxic"])


def _fit(features: np.ndarray, labels: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton's method, drawn toward the grammar's own."""
    weights = OWN_WEIGHTS.copy()
    # The length and the number of matches are free, kinds of clauses are held to the grammar.
    pull = np.array([0.01, 1.0, 1.0, 1.0, 1.0, 1.0, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (share * (labels - p)) - pull * (weights - OWN_WEIGHTS)
        bend = (features * (share * p * (1 - p))[:, None]).T @ features + np.diag(pull)
        step = np.linalg.solve(bend, slope)
        weights = weights + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return weights


def learn(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLED, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Model:
    """The lexicon and the weights, from labelled documents that are not held out."""
    known = labels.select(F.col(key).alias("doc_id"), (F.col(label) == 1).cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.where(doc_fold(F.col("doc_id")) != 1)
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    # At most 2 * per_class rows.
    picked = store(hash_sample(known, "toxic", ["doc_id"], per_class), "labelled")
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    sample = named.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = store(sample.repartition("doc_id"), "learned-from")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model({}, 0.1, OWN_WEIGHTS)
    # How many documents a sampled one of class 0 stands for, for each of class 1.
    share = (totals[0] / sizes[0]) / (totals[1] / sizes[1])
    base = sizes[1] / (sizes[1] + share * sizes[0])
    counts = sample.select("text", "toxic").mapInArrow(_entries, "entry string, toxic int")
    counts = store(counts.groupBy("entry").agg(F.sum(1 - F.col("toxic")).alias("other"), F.sum("toxic").alias("toxic")), "entries")
    chance = F.col("toxic") / (F.col("toxic") + F.lit(share) * F.col("other"))
    marked = counts.where((F.col("toxic") >= 2) & (chance >= (base + LEAST_CHANCE) / 2))
    # Words that are met in other documents count where a prefix of theirs is marked.
    prefixes = store(marked.where(~F.col("entry").endswith("$")).select(F.col("entry").alias("prefix")), "prefixes")
    lengths = F.array(*[F.lit(n) for n in range(SHORTEST, LONGEST + 1)])
    begun = counts.withColumn("begin", F.explode(F.transform(lengths, lambda n: F.substring("entry", F.lit(1), n))))
    begun = begun.join(prefixes, F.col("begin") == F.col("prefix"), "left_semi").select("entry", "other", "toxic").distinct()
    # All from the sample, so bounded by its texts.
    kept = marked.select("entry", "other", "toxic").unionByName(begun).distinct()
    trie = {r["entry"]: (share * r["other"], float(r["toxic"])) for r in kept.toArrow().to_pylist()}
    lexicon, grammar = Lexicon(trie, base), Grammar()

    @F.pandas_udf("array<double>")
    def described(texts: pd.Series, toxic: pd.Series) -> pd.Series:
        own = ((share, 0.0), (0.0, 1.0))
        return pd.Series([grammar.features(lexicon.read(t, own[y]) for t in tokens(x or "")).tolist() for x, y in zip(texts, toxic)])

    rows = sample.select("doc_id", "toxic", described("text", "toxic").alias("f")).orderBy("doc_id", "toxic").toArrow()
    features, toxic = np.array(rows.column("f").to_pylist()), rows.column("toxic").to_numpy()
    return Model(trie, base, _fit(features, toxic, np.where(toxic == 1, 1.0, share)))


def score_with(model: Model) -> Column:
    """An expression maker: the score of a text column."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        score = model.scorer()
        return pd.Series([score(t) for t in texts], dtype="float64")

    return scored


def judge(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    held_out = F.coalesce(doc_fold(F.col("doc_id")) == 1, F.lit(False))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = rows.select("doc_id", held_out.alias("held_out"), score_with(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
