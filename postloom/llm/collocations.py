"""Phrase collocations with mergeable Misra-Gries summaries and an exact second pass.

Texts fall into pieces at punctuation and line ends, and pieces into words; an n-gram is one to three
words in a row inside a piece, counted per language. The first pass sends the hashed n-grams, combined
within a task, to hash partitions and keeps a Misra-Gries summary of each. Summaries merge: counters
are added, and when there are more than the capacity, all give up the largest count that is left over.
What counters gave up in all is the error; the capacity doubles before the error could pass half the
threshold, so it always exceeds the mass over the error, and no n-gram that occurs `least` times is lost,
whatever the data. A summary holds a bounded part of the mass, as the number of partitions follows the
number of bytes. Each hash partition marks its survivors in its own bits of a map of bounded size, and the
second pass counts exactly, by their text, all n-grams at marked places: hashes only choose, and where the
map is crowded by larger data it lets more through, which are counted and then dropped.

The words of a frequent phrase and its parts are as frequent, so the counts of all cuts are at hand. A
phrase's score is that of its lowest-scoring cut; the smallest cut at a tie. Phrases that a longer
candidate holds half of the time or more are dropped. Scores are exact in decimals of 38 digits: right
for counts up to 10 ** 15.

Null languages are "und", null texts are empty; texts of any length are cut at piece ends, where no
n-gram is lost. Rows are counted as they come, repeated or not. Ties of score and count go by the bytes
of the phrase. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import mix64
from postloom.operators.ordering import running_totals
from postloom.session import store

LONGEST = 3
CHUNK_BYTES = 1 << 20
MASS_PER_PART = 4_000_000  # occurrences of n-grams in a hash partition, about
BYTES_PER_GRAM = 2  # of text, about: a word of five letters and a space begins three n-grams
COUNTERS = 1 << 18  # the capacity a summary begins with
MERGED = 1 << 20  # n-grams a task combines before it sends them
PART_BITS = 1 << 20  # of the map, for a hash partition
MAP_BITS = 1 << 29  # of the map in all, 64 MB

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_random = np.random.default_rng(12)
# Two independent hashes of a word: a random number per byte, weighted by powers of an odd number.
_BYTES = _random.integers(0, 2**64, size=(2, 256), dtype=np.uint64)
_BASES, _JOINS = (_random.integers(0, 2**64, size=2, dtype=np.uint64) | np.uint64(1) for _ in range(2))


@dataclass
class Grams:
    """All n-grams of a chunk: two hashes, the first word and the number of words of each."""

    hashes: tuple[np.ndarray, np.ndarray]
    first: np.ndarray
    size: np.ndarray
    code: np.ndarray  # the language of each word, as a number
    starts: np.ndarray  # of each word in `text`
    lengths: np.ndarray
    text: np.ndarray  # words in lower case, each followed by a space

    def phrases(self, which: np.ndarray) -> pa.Array:
        """The texts of some n-grams, their words joined by one space."""
        last = self.first[which] + self.size[which] - 1
        begin = self.starts[self.first[which]]
        lengths = self.starts[last] + self.lengths[last] - begin
        ends = np.concatenate([[0], np.cumsum(lengths)])
        data = self.text[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], lengths)]
        return pa.Array.from_buffers(pa.string(), len(which), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def split(raw: np.ndarray, ends: np.ndarray, codes: np.ndarray, salts: np.ndarray) -> Grams | None:
    """The n-grams of the UTF-8 bytes of texts that end at `ends`."""
    kind = _KIND[raw]
    inside = kind == 0
    opens = np.zeros(len(raw) + 1, dtype=bool)
    opens[0] = True
    opens[ends] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | opens[:-1]))
    if not len(starts):
        return None
    after = np.concatenate([inside[1:], [False]])
    stops = np.flatnonzero(inside & (~after | opens[1:])) + 1
    lengths = stops - starts
    text = np.searchsorted(ends, starts, side="right")
    breaks = np.cumsum(kind == 2, dtype=np.int32)
    joined = (text[1:] == text[:-1]) & (breaks[starts[1:]] == breaks[stops[:-1] - 1])
    letters = _LOWER[raw[inside]]
    offsets = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(offsets, lengths)
    code = codes[text]
    salt = salts[code]
    hashes = []
    for values, base, join in zip(_BYTES, _BASES, _JOINS):
        powers = np.cumprod(np.full(int(lengths.max()), base), dtype=np.uint64)
        word = mix64(np.add.reduceat(values[letters] * powers[place], offsets))
        one = mix64(word + salt)
        two = mix64(one[:-1] * join + word[1:])
        three = mix64(two[:-1] * join + word[2:])
        hashes.append((one, two, three))
    triple = joined[:-1] & joined[1:]
    where = [np.arange(len(starts)), np.flatnonzero(joined), np.flatnonzero(triple)]
    compact = np.full(len(letters) + len(starts), 32, dtype=np.uint8)
    compact[np.arange(len(letters)) + np.repeat(np.arange(len(starts)), lengths)] = letters
    return Grams(
        tuple(np.concatenate([h[i] for h, i in zip(chain, where)]) for chain in hashes),
        np.concatenate(where), np.repeat(np.arange(1, 4), [len(w) for w in where]),
        code, offsets + np.arange(len(starts)), lengths, compact,
    )


def _windows(raw: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of chunks of about CHUNK_BYTES that begin and end where a piece or a text does."""
    at = 0
    while at < len(raw):
        stop = min(at + CHUNK_BYTES, len(raw))
        while stop < len(raw):
            of_text = ends[np.searchsorted(ends, stop)]
            part = np.flatnonzero(_KIND[raw[stop - 1 : stop - 1 + CHUNK_BYTES]] == 2)
            piece = stop + int(part[0]) if len(part) else stop - 1 + CHUNK_BYTES
            stop = min(int(of_text), piece, len(raw))
            if len(part) or stop == of_text:
                break
        yield at, stop
        at = stop


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def chunks(batch: pa.RecordBatch) -> Iterator[tuple[Grams, list[str]]]:
    """The n-grams of rows (lang, text), with the names of the languages."""
    langs = pc.fill_null(batch.column("lang"), "und").dictionary_encode()
    names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
    salts = np.array([_salt(n) for n in names], dtype=np.uint64)
    texts = pc.cast(pc.fill_null(batch.column("text"), ""), pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return
    raw, ends = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]
    for start, stop in _windows(raw, ends):
        of = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        grams = split(raw[start:stop], np.minimum(ends[of[0] : of[1]], stop) - start, codes[of[0] : of[1]], salts)
        if grams is not None:
            yield grams, names


def _addresses(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Hash partition and 32 bits inside it. Others may share them: then more survive, never fewer."""
    return ((hashes >> np.uint64(32)) % np.uint64(parts) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _send(parts: int) -> Callable:
    """First pass: per hash partition the addresses and counts of a task's n-grams, packed."""

    def packed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, counts = _summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
        part = (keys >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        bounds = np.append(first, len(keys)).astype(np.int32) * 4
        cells = [
            pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(x.astype("<u4"))])
            for x in (keys & np.uint64(0xFFFFFFFF), np.minimum(counts, 2**32 - 1))
        ]
        return pa.RecordBatch.from_arrays([pa.array(part[first].astype(np.int64)), *cells], names=["part", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for grams, _ in chunks(batch):
                held.append(np.unique(_addresses(grams.hashes[0], parts), return_counts=True))
                if sum(len(k) for k, _ in held) >= MERGED:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    return run


class Summary:
    """A Misra-Gries summary: counters that lack at most `error` of the true counts."""

    def __init__(self, least: int, capacity: int | None = None):
        self.least, self.capacity, self.error = least, COUNTERS if capacity is None else capacity, 0
        self.keys, self.counts = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        self._held: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._held.append((keys, counts.astype(np.int64)))
        self._size += len(keys)
        if self._size > self.capacity:
            self.merge()

    def merge(self) -> None:
        held = [(self.keys, self.counts), *self._held]
        self.keys, self.counts = _summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
        self._held, self._size = [], 0
        while len(self.keys) > self.capacity:
            given_up = int(np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1])
            if self.error + given_up > self.least // 2:
                self.capacity *= 2
                continue
            self.error += given_up
            left = self.counts > given_up
            self.keys, self.counts = self.keys[left], self.counts[left] - given_up

    def survivors(self) -> np.ndarray:
        """Every key that occurs `least` times, and some that nearly do."""
        self.merge()
        return self.keys[self.counts + self.error >= self.least]


def bits_per_part(parts: int) -> int:
    """A power of two, so that the map has MAP_BITS bits at most."""
    return 1 << int(np.log2(max(8, min(PART_BITS, MAP_BITS / parts))))


def _places(addresses: np.ndarray, bits: int) -> np.ndarray:
    """The bit of each address in a map with so many bits for each part."""
    inside = (addresses & np.uint64(0xFFFFFFFF)) * np.uint64(bits) >> np.uint64(32)
    return (addresses >> np.uint64(32)) * np.uint64(bits) + inside


def _summarise(least: int, bits: int) -> Callable:
    """Rows sorted by hash partition: the part of the map that marks the survivors of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(part: int, summary: Summary) -> pa.RecordBatch:
            marked = np.zeros(bits, dtype=bool)
            marked[_places(summary.survivors().astype(np.uint64), bits).astype(np.int64)] = True
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([np.packbits(marked, bitorder="little").tobytes()])], names=["part", "bits"])

        current, summary = None, Summary(least)
        for batch in batches:
            for part, keys, counts in zip(batch.column("part").to_pylist(), batch.column("keys"), batch.column("counts")):
                if part != current:
                    if current is not None:
                        yield told(current, summary)
                    current, summary = part, Summary(least)
                summary.add(np.frombuffer(keys.as_buffer(), dtype="<u4"), np.frombuffer(counts.as_buffer(), dtype="<u4"))
        if current is not None:
            yield told(current, summary)

    return run


def _count(parts: int, bits: int, marked: Broadcast) -> Callable:
    """Second pass: the exact counts (lang, size, phrase, n) of the n-grams at marked places, and the
    number of words as size 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_out = ["lang", "size", "phrase", "n"]
        for batch in batches:
            for grams, names in chunks(batch):
                place = _places(_addresses(grams.hashes[0], parts), bits)
                byte = marked.value[(place >> np.uint64(3)).astype(np.int64)]
                which = np.flatnonzero(byte >> (place & np.uint64(7)).astype(np.uint8) & 1)
                one, two = grams.hashes[0][which], grams.hashes[1][which]
                counts = np.zeros(0, dtype=np.int64)
                if len(which):
                    order = np.argsort(one)
                    same = one[order[1:]] == one[order[:-1]]
                    if (same & (two[order[1:]] != two[order[:-1]])).any():  # one hash, two phrases
                        order = np.lexsort((two, one))
                        same = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
                    first = np.flatnonzero(np.concatenate([[True], ~same]))
                    counts = np.diff(np.append(first, len(order)))
                    which = which[order[first]]
                langs = pa.DictionaryArray.from_arrays(pa.array(grams.code[grams.first[which]]), pa.array(names, pa.string())).dictionary_decode()
                yield pa.RecordBatch.from_arrays([langs, pa.array(grams.size[which], pa.int32()), grams.phrases(which), pa.array(counts, pa.int64())], names=names_out)
                words = np.bincount(grams.code, minlength=len(names))
                none = [pa.array([0] * len(names), pa.int32()), pa.array([""] * len(names))]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *none, pa.array(words, pa.int64())], names=names_out)

    return run


def frequent(docs: DataFrame, least: int = 10, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, size, phrase and f of every n-gram that occurs `least` times, and as size 0 the words of
    each language; stored."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // (BYTES_PER_GRAM * MASS_PER_PART)))
    bits = bits_per_part(parts)
    sent = rows.mapInArrow(_send(parts), "part long, keys binary, counts binary")
    dealt = sent.repartition("part").sortWithinPartitions("part")
    found = dealt.mapInArrow(_summarise(least, bits), "part long, bits binary").toArrow()
    marked = np.zeros(parts * bits // 8, dtype=np.uint8)
    for part, own in zip(found.column("part").to_pylist(), found.column("bits")):
        marked[part * bits // 8 : (part + 1) * bits // 8] = np.frombuffer(own.as_buffer(), dtype=np.uint8)
    # MAP_BITS at most, whatever the data.
    sent_map = docs.sparkSession.sparkContext.broadcast(marked)
    found = rows.mapInArrow(_count(parts, bits, sent_map), "lang string, size int, phrase string, n long")
    totals = found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f"))
    return store(totals.where((F.col("size") == 0) | (F.col("f") >= least)), "frequent")


def _found_in(rows: DataFrame, counts: DataFrame, size: int, part: str, name: str) -> DataFrame:
    """`rows` with the count of the n-gram in the column `part`, null where there is none."""
    table = counts.where(F.col("size") == size).select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias(name))
    return rows.join(table, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_phrase")), "left").drop("_lang", "_phrase", part)


def collocations(docs: DataFrame, least: int = 10, first: int = 2_000, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the `first` phrases of each language."""
    counts = frequent(docs, least, text, lang)
    phrases = counts.where("size >= 2").select("lang", "size", "phrase", F.col("f").alias("a")).withColumns({
        "head": F.substring_index("phrase", " ", 1), "tail": F.substring_index("phrase", " ", -1),
        "start": F.when(F.col("size") == 3, F.substring_index("phrase", " ", 2)),
        "rest": F.when(F.col("size") == 3, F.substring_index("phrase", " ", -2)),
    })
    held = phrases.where("size = 3").select("lang", F.explode(F.array_distinct(F.array("start", "rest"))).alias("phrase"), "a")
    held = store(held.groupBy("lang", "phrase").agg(F.max("a").alias("f")), "held")
    drop = F.coalesce(100 * F.col("held") >= 50 * F.col("a"), F.lit(False))
    known = phrases.join(held.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias("held")), (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")) & (F.col("size") == 2), "left")
    known = known.where(~drop).drop("_lang", "_phrase", "held")
    for size, part in ((1, "head"), (1, "tail"), (2, "start"), (2, "rest")):
        known = _found_in(known, counts, size, part, f"of_{part}")
    two = F.col("size") == 2
    cuts = [("of_head", F.when(two, F.col("of_tail")).otherwise(F.col("of_rest"))), ("of_start", F.col("of_tail"))]
    exact = lambda c: c.cast("decimal(18, 0)")
    scored = known.withColumns({"l1": F.col(cuts[0][0]), "r1": cuts[0][1], "l2": F.col(cuts[1][0]), "r2": F.when(~two, cuts[1][1])})
    for i in (1, 2):
        scored = scored.withColumns({"_a": exact(F.col("a")), "_l": exact(F.col(f"l{i}")), "_r": exact(F.col(f"r{i}"))})
        scored = scored.withColumn(f"s{i}", F.expr("(1000000BD * (_a * _a)) div (_l * _r)"))
    second = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    pick = lambda c: F.when(second, F.col(f"{c}2")).otherwise(F.col(f"{c}1"))
    scored = scored.select("lang", "phrase", "a", pick("l").alias("l"), pick("r").alias("r"), pick("s").alias("score"))
    order = scored.withColumns({"by_score": -F.col("score"), "by_a": -F.col("a")})
    # Positions over all languages: no task ever holds the phrases of a whole language.
    placed = store(running_totals(order, ["lang", "by_score", "by_a", "phrase"], {"place": "1"}), "placed")
    starts = store(placed.groupBy("lang").agg(F.min("place").alias("start")), "starts").withColumnRenamed("lang", "_lang")
    ranked = placed.join(starts, F.col("lang") == F.col("_lang")).withColumn("rank", F.expr("place - start + 1")).where(F.col("rank") <= first)
    words = counts.where("size = 0").select(F.col("lang").alias("_of"), F.col("f").alias("n"))
    return ranked.join(words, F.col("lang") == F.col("_of")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
