"""Token counts of a byte-level BPE vocabulary: merges by heap and linked list, no ids emitted.

A text is cut at the vocabulary's special strings (one token each), at line ends and single spaces,
where words cannot run on, and then into words by the pattern of byte-level BPE. The symbols of a word, at first its bytes, form a doubly linked list; a
heap holds the adjacent pairs that the vocabulary can merge. The pair of the lowest rank, leftmost
first, is popped and merged until the heap is empty: the count is the symbols at the start minus
the merges.

Null and empty texts have no tokens. Every text is read whole; one word of any length costs
n log n. Rows are independent, so ties, repeats and further columns do not matter.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# Counts of words and of pieces seen are remembered up to this many in each Python worker.
REMEMBERED_WORDS = 500_000

# The word pattern of byte-level BPE, white space as Unicode's White_Space.
_SPACE = r"\t-\r\x20\x85\p{Z}"
WORDS = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_BLANKS = frozenset(chr(c) for c in range(0x3001) if regex.match(f"[{_SPACE}]", chr(c)))
_PAIR = 24  # bits of a symbol in the key of a pair
_AT = 40  # bits of a place in a heap entry
_PLACE = (1 << _AT) - 1


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


# Stands for "this piece cannot be counted on its own"; far below any count, so that a sum shows it.
_JOINED = -(1 << 50)


class _Pieces(dict):
    """Tokens by piece of text between two single spaces, each taken together with `before`."""

    def __init__(self, words: BpeCounter, before: str):
        super().__init__()
        self.words, self.before = words, before

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        tokens = self.words.tokens
        if piece.isalpha():
            count = tokens(self.before + piece)
        elif piece[-1:] in ".,;:?!" and piece[:-1].isalpha():
            count = tokens(self.before + piece[:-1]) + tokens(piece[-1])
        elif piece and piece[0] not in _BLANKS and piece[-1] not in _BLANKS:
            count = sum(map(tokens, WORDS.findall(self.before + piece)))
        else:
            count = _JOINED
        self[piece] = count
        return count


class BpeCounter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        number: dict[str, int] = {}

        def symbol(text: str) -> int:
            return number.setdefault(text, len(number))

        self.of_byte = [symbol(c) for c in _byte_symbols()]
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[symbol(left) << _PAIR | symbol(right)] = rank
            self.merged.append(symbol(left + right))
        specials = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.seen: dict[str, int] = {}
        self.at_line_start, self.after_space = _Pieces(self, ""), _Pieces(self, " ")
        self.line_end = self.tokens("\n")

    def tokens(self, word: str) -> int:
        count = self.seen.get(word)
        if count is None:
            if len(self.seen) >= REMEMBERED_WORDS:
                self.seen.clear()
            count = self.seen[word] = self.merge(word.encode("utf-8", "surrogatepass"))
        return count

    def merge(self, word: bytes) -> int:
        size = len(word)
        if size < 2:
            return size
        rank, merged = self.rank.get, self.merged
        symbols = list(map(self.of_byte.__getitem__, word))
        heap = [
            found << _AT | at
            for at, found in enumerate(map(rank, [a << _PAIR | b for a, b in zip(symbols, symbols[1:])]))
            if found is not None
        ]
        if not heap:
            return size
        heapify(heap)
        right, left = list(range(1, size + 1)), list(range(-1, size))
        symbols.append(-1)
        merges = 0
        while heap:
            entry = heappop(heap)
            at = entry & _PLACE
            after = right[at]
            now = entry >> _AT
            # An entry is stale when either of its symbols has been merged away since.
            if symbols[at] < 0 or symbols[after] < 0 or rank(symbols[at] << _PAIR | symbols[after]) != now:
                continue
            merges += 1
            symbol = symbols[at] = merged[now]
            symbols[after] = -1
            beyond = right[at] = right[after]
            left[beyond] = at
            if beyond < size:
                found = rank(symbol << _PAIR | symbols[beyond])
                if found is not None:
                    heappush(heap, found << _AT | at)
            before = left[at]
            if before >= 0:
                found = rank(symbols[before] << _PAIR | symbol)
                if found is not None:
                    heappush(heap, found << _AT | before)
        return size - merges

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.specials is None:
            return self._words(text)
        total, start = 0, 0
        for found in self.specials.finditer(text):
            total += self._words(text[start:found.start()]) + 1
            start = found.end()
        return total + self._words(text[start:] if start else text)

    def _words(self, text: str) -> int:
        """Line by line and piece by piece; where blanks meet, the whole text by the pattern."""
        if not text:
            return 0
        total = -self.line_end
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            total += self.line_end + self.at_line_start[first] + sum(map(self.after_space.__getitem__, rest))
        return total if total >= 0 else sum(self.tokens(found.group()) for found in WORDS.finditer(text))


_counters: dict[str, BpeCounter] = {}


def counter(path: str) -> BpeCounter:
    """The counter of a vocabulary file, kept for the life of the Python process."""
    if path not in _counters:
        _counters[path] = BpeCounter(path)
    return _counters[path]


def n_tokens(path: str = DEFAULT_VOCABULARY) -> Callable[[Column], Column]:
    """A function from a text column to its token counts; 0 for null."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        vocabulary = counter(path)
        return pd.Series([vocabulary.count(text) for text in texts], dtype="int64")

    return count


def token_counts(
    docs: DataFrame, path: str = DEFAULT_VOCABULARY, limit: int = 1024, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Bytes, tokens and whether the tokens exceed `limit`, one row per document."""
    counted = docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        n_tokens(path)(F.col(text)).alias("n_tokens"),
    )
    return counted.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
