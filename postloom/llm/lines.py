"""Substring deduplication by hashing lines, in pieces where they are long.

A text is cut after line breaks and after sentences (words that end in ".", "!" or "?"). Longer ones
are cut further, after a comma, semicolon, colon or a word that its own hash picks (one in eight), as
soon as MIN_WORDS words have gathered: these places depend on what is near, so the units of a passage
fall into step wherever the passage starts. Shorter sentences of a line that follow each other are one
unit, as soon as together they have MIN_WORDS words. Each unit is normalised (lower case, white space
as single spaces) and has a 128-bit digest when it has MIN_WORDS words or is a whole line of any
length. In scripts written without spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese, Tibetan) a
text can be cut at each character (one in sixteen is picked), their own marks end sentences, and
WORD_CHARS characters are as long as a word; runs of LONG_RUN characters of other scripts count by
their characters too. Over all documents the occurrence of a digest that ranks first, by document id (null last) and
then by offset, is kept and every other one is removed. Short parts of a line are too common to tell
copies from chance: one goes only when its neighbours in the line, up to the next unit with a digest
on both sides, go too. Removed spans keep their offsets in the original text, in characters.

A whole line that repeats, of any sentence structure, is removed whole, and so is a paragraph, line by
line. Lines of one to three words are too common to be copies by themselves: they are compared, but go
only when, with the lines next to them that go as well, at least LINE_WORDS words go. Of a passage inside a line the first and last few words can stay, joined to
foreign ones. Null and empty texts have no units and come back as they are. Rows that repeat an id and
its text are one document: their units keep or lose alike. Rows without an id rank last, by a hash of
their text. Further columns are passed on. A unit that any number of documents share is one group of
one combining aggregate; no group is gathered anywhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.session import store

MIN_WORDS = 8
# Repeated whole lines with fewer words go only where they are next to others that go.
LINE_WORDS = 4
# So many characters without spaces are as long as a word; runs of other scripts from LONG_RUN characters on.
WORD_CHARS = 3
LONG_RUN = 40
_UNSPACED = (
    "\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3001-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\uff01-\uff9f\U00020000-\U0003ffff"
)
_WORDS = re.compile(rf"\n|([{_UNSPACED}])|[^\s{_UNSPACED}]+")
_WITHOUT_SPACES = re.compile(rf"[{_UNSPACED}]")
_SENTENCE_ENDS = frozenset(".!?。．！？｡")
_PAUSES = frozenset(",;:，、；：､")
_UNITS = "id long, row long, rest long, unit int, high long, low long"


def _length(found: re.Match[str]) -> int:
    """Of a match of `_WORDS`, in characters; ordinary words count as WORD_CHARS each."""
    if found.lastindex:
        return 1
    n = found.end() - found.start()
    return n if n >= LONG_RUN else WORD_CHARS


def _size(unit: str, words: list[str]) -> int:
    """The sum of `_length` over a unit, which has these words between its spaces."""
    if (unit.isascii() or not _WITHOUT_SPACES.search(unit)) and all(len(w) < LONG_RUN for w in words):
        return WORD_CHARS * len(words)
    return sum(_length(found) for found in _WORDS.finditer(unit) if found[0] != "\n")


def cut(text: str, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """The units as offsets; they cover the text.

    White space tells a short part of a line from a whole line: a part has some at its start, or at
    its end when it begins the line; a whole line has none but its line break.
    """
    least = min_words * WORD_CHARS
    ends: list[int] = []
    line: list[tuple[int, int]] = []  # ends and sizes of the pieces of the line
    size = 0
    for found in _WORDS.finditer(text):
        word = found[0]
        if word == "\n":
            _close(text, line, size, found.end(), ends, least)
            line, size = [], 0
            continue
        last = word[-1]
        size += _length(found)
        if last in _SENTENCE_ENDS or size >= least and (
            last in _PAUSES or not crc32(word.lower().encode("utf-8", "surrogatepass")) & (15 if found.lastindex else 7)
        ):
            line.append((found.end(), size))
            size = 0
    if not ends or ends[-1] < len(text):
        _close(text, line, size, len(text), ends, least)
    return list(zip([0, *ends], ends))


def _close(text: str, line: list[tuple[int, int]], size: int, end: int, ends: list[int], least: int) -> None:
    """Adds the ends of the units of a line, from its pieces and the size of the words after them."""
    start = ends[-1] if ends else 0
    pieces = [*line, (end, size)] if size or not line else [*line[:-1], (end, line[-1][1])]
    runs: list[tuple[int, int]] = []
    for at, n in pieces:
        if runs and runs[-1][1] < least and n < least:
            runs[-1] = (at, runs[-1][1] + n)
        else:
            runs.append((at, n))
    # Where no space parts a short piece from its neighbour, they are one unit.
    units: list[tuple[int, int]] = []
    for at, n in runs:
        if units and min(n, units[-1][1] if len(units) == 1 else n) < least and not text[units[-1][0]].isspace():
            units[-1] = (at, units[-1][1] + n)
        else:
            units.append((at, n))
    if units[0][1] < least:
        if len(units) > 1:
            first = units[0][0]
            ends.append(first + len(text[first:end]) - len(text[first:end].lstrip()))
            units = units[1:]
        elif units[0][1]:
            content = text[start:end]
            if content[0].isspace():
                ends.append(start + len(content) - len(content.lstrip()))
            if content[-1] != "\n" and content[-1].isspace():
                ends.append(start + len(content.rstrip()))
    ends.extend(at for at, _ in units)


def _hashed(unit: str, words: list[str], min_words: int) -> bool:
    """Whether a unit of these words has a digest: a long one, or a whole line (see `cut`)."""
    whole = bool(words) and not unit[0].isspace() and (unit[-1] == "\n" or not unit[-1].isspace())
    return whole or _size(unit, words) >= min_words * WORD_CHARS


def digest(unit: str, min_words: int = MIN_WORDS) -> bytes | None:
    words = unit.lower().split()
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass")) if _hashed(unit, words, min_words) else None


def _digests(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, numbers, digests = [], [], []
            for place, text in enumerate(batch.column("text")):
                text = text.as_py()
                for number, (start, end) in enumerate(cut(text, min_words) if text else ()):
                    found = digest(text[start:end], min_words)
                    if found is not None:
                        places.append(place)
                        numbers.append(number)
                        digests.append(found)
            halves = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            of = [batch.column(c).take(pa.array(places, pa.int64())) for c in ("id", "row", "rest")]
            yield pa.RecordBatch.from_arrays(
                [*of, pa.array(numbers, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                names=["id", "row", "rest", "unit", "high", "low"],
            )

    return run


def removed_spans(text: str, gone: set[int], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Spans of the removed units, and of the short ones that only have removed neighbours in their line.

    Runs of removed units that hold less than LINE_WORDS words together stay.
    """
    units = cut(text, min_words)
    out = [number in gone for number in range(len(units))]
    line: list[int] = []

    def close() -> None:
        parts = [text[units[i][0] : units[i][1]] for i in line]
        short = [i not in gone and not _hashed(part, part.split(), min_words) for i, part in zip(line, parts)]
        at = 0
        while at < len(line):
            end = at
            while end < len(line) and short[end]:
                end += 1
            if end > at:
                before, after = at == 0 or out[line[at - 1]], end == len(line) or out[line[end]]
                if before and after and end - at < len(line):
                    for i in line[at:end]:
                        out[i] = True
            at = end + 1

    for number, (start, end) in enumerate(units):
        line.append(number)
        if text[start:end].endswith("\n"):
            close()
            line = []
    if line:
        close()
    spans: list[tuple[int, int]] = []
    for removed, (start, end) in zip(out, units):
        if removed and spans and spans[-1][1] == start:
            spans[-1] = (spans[-1][0], end)
        elif removed:
            spans.append((start, end))
    least = min(LINE_WORDS, min_words) * WORD_CHARS
    return [(start, end) for start, end in spans if end - start > 400 or _size(text[start:end], text[start:end].split()) >= least]


def _without(min_words: int):
    @F.pandas_udf("text string, removed array<struct<start: int, end: int>>")
    def run(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        kept, spans = [], []
        for text, units in zip(texts, gone):
            if text is None or units is None:
                kept.append(text)
                spans.append([])
                continue
            found = removed_spans(text, set(units), min_words)
            parts, at = [], 0
            for start, end in found:
                parts.append(text[at:start])
                at = end
            kept.append("".join([*parts, text[at:]]))
            spans.append([{"start": start, "end": end} for start, end in found])
        return pd.DataFrame({"text": kept, "removed": spans})

    return run


def _row(key: Column, text: Column) -> tuple[Column, Column]:
    """Two hashes that together stand for a document: its id and text. The seed comes first, so that
    they do not depend on each other."""
    return F.xxhash64(F.lit(1), key, text), F.xxhash64(F.lit(2), key, text)


def repeated_units(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """Per document (`row`, `rest`) the numbers of the units to remove (`gone`)."""
    row, rest = _row(F.col(key), F.col(text))
    rows = docs.select(F.col(key).cast("long").alias("id"), row.alias("row"), rest.alias("rest"), F.col(text).alias("text"))
    units = store(rows.where(F.length("text") > 0).mapInArrow(_digests(min_words), _UNITS), "units")
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row", "rest", "unit")
    firsts = (
        units.groupBy("high", "low").agg(F.min(place).alias("first"), F.count("*").alias("times"))
        .where(F.col("times") > 1)
        .select(F.col("high").alias("h"), F.col("low").alias("l"), F.col("first.row").alias("first_row"), F.col("first.rest").alias("first_rest"), F.col("first.unit").alias("first_unit"))
    )
    # Stored apart from the join with it, so that Spark can split the join at a unit that very many share.
    firsts = store(firsts, "firsts")
    again = units.join(firsts, (units["high"] == firsts["h"]) & (units["low"] == firsts["l"])).where(
        (F.col("row") != F.col("first_row")) | (F.col("rest") != F.col("first_rest")) | (F.col("unit") != F.col("first_unit"))
    )
    # Stored apart from the next aggregate for the same reason.
    again = store(again.select("row", "rest", "unit"), "repeats")
    # Rows that repeat a document give its units again; a set holds each once.
    return again.groupBy("row", "rest").agg(F.collect_set("unit").alias("gone"))


def _cut_texts(docs: DataFrame, text: str, key: str, min_words: int) -> DataFrame:
    """The documents with `_line_cut`: the text without repeats, and the spans removed."""
    gone = repeated_units(docs, text, key, min_words)
    gone = gone.select(F.col("row").alias("_line_row"), F.col("rest").alias("_line_rest"), F.col("gone").alias("_line_gone"))
    row, rest = _row(F.col(key), F.col(text))
    keyed = docs.withColumns({"_line_key": row, "_line_key_rest": rest})
    joined = keyed.join(gone, (F.col("_line_key") == F.col("_line_row")) & (F.col("_line_key_rest") == F.col("_line_rest")), "left")
    return joined.withColumn("_line_cut", _without(min_words)(F.col(text), F.col("_line_gone")))


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns with the text cut, and `removed`, the spans taken out of the original text.

    A column of the input that is called `removed` is replaced.
    """
    kept = [F.col("_line_cut.text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c != "removed"]
    return _cut_texts(docs, text, key, min_words).select(*kept, F.col("_line_cut.removed").alias("removed"))


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with their columns as they were, repeated passages cut from the texts."""
    kept = [F.col("_line_cut.text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return _cut_texts(docs, text, key, min_words).select(*kept)
