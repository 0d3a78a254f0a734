"""Language identification by compression.

Each language has dictionaries: raw text of a bounded sample of its documents. A text is lower-cased,
runs of other characters than letters become one space, and it is compressed in blocks with the first
dictionary of each language. The language that gives the fewest bytes over the whole text is
predicted; ties go to the language with more sampled text, then by name. The margin is the share of
bytes saved against the runner-up. Where it is under `narrow`, as for texts of a few words, the
further dictionaries of each language are added and the mean sizes over its dictionaries compared, so
that a language with few documents, and so fewer dictionaries, changes nothing for the others; a
prediction whose margin is narrow even then is marked as rejected.

Null texts and texts without any letter are `und` with score 0 and rejected. With no learned
language every text is `und`. Repeated rows are scored alike; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import doc_fold, hash_sample

# Bounds of what is learned: documents per language, characters of each, bytes of a dictionary.
SAMPLED_DOCS = 256
SAMPLED_CHARS = 1_500
DICTIONARY_BYTES = 32_768
DICTIONARIES = 4
# Each block of a long text is compressed from the dictionary anew, so that it stays in force.
BLOCK_BYTES = 4_096
LEVEL = 6
# Predictions that save less than this share of the bytes against the runner-up are rejected.
NARROW = 0.002
UNKNOWN = "und"

_OTHER = regex.compile(r"[\W\d_]+")

Dictionaries = dict[str, list[bytes]]


def normalise(text: str | None) -> bytes:
    """Lower-case letters with single spaces between; empty when the text has no letter."""
    if not text:
        return b""
    return _OTHER.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def learn(
    docs: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id", sampled_docs: int = SAMPLED_DOCS
) -> Dictionaries:
    """The dictionaries of each language, from at most `sampled_docs` documents of each.

    Only documents with a language, a text and a fold (see `doc_fold`) other than 1 are read.
    What comes to the driver is bounded by languages x sampled_docs x SAMPLED_CHARS.
    """
    known = docs.select(F.col(key).alias("id"), F.col(language).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (doc_fold(F.col("id")) != 1)
    )
    sample = hash_sample(known, "lang", ["id"], sampled_docs).select(
        "lang", F.substring("text", 1, SAMPLED_CHARS).alias("text"), F.xxhash64("text").alias("order")
    )
    gathered: dict[str, list[tuple[int, bytes]]] = {}
    for row in sample.collect():
        gathered.setdefault(row["lang"], []).append((row["order"], normalise(row["text"])))
    found: Dictionaries = {}
    for lang, texts in gathered.items():
        contents = []
        for i in range(DICTIONARIES):
            part = [t for _, t in sorted(texts)[i::DICTIONARIES] if t]
            # An equal share of each document, so that a dictionary holds many of them.
            share = max(1, DICTIONARY_BYTES // max(len(part), 1))
            contents.append(b" ".join(t[:share] for t in part)[:DICTIONARY_BYTES])
        contents = [c for c in contents if len(c) >= 8]  # a shorter content is no dictionary
        if contents:
            found[lang] = contents
    return dict(sorted(found.items(), key=lambda item: (-sum(map(len, item[1])), item[0])))


class Classifier:
    def __init__(self, dictionaries: Dictionaries, narrow: float = NARROW):
        self.narrow = narrow
        self.compress = {lang: [_compressor(content) for content in contents] for lang, contents in dictionaries.items()}
        self.more = any(len(each) > 1 for each in self.compress.values())

    def _sizes(self, blocks: list[bytes], last: int) -> dict[str, float]:
        """By language the mean number of bytes over its first dictionaries, up to `last`."""
        return {
            lang: sum(len(compress(block)) for compress in each[:last] for block in blocks) / len(each[:last])
            for lang, each in self.compress.items()
        }

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """The language, a score from 0 to 1, and whether the prediction is rejected."""
        if not self.compress or not has_letter(text):
            return UNKNOWN, 0.0, True
        content = normalise(text)
        blocks = [content[at : at + BLOCK_BYTES] for at in range(0, len(content), BLOCK_BYTES)]
        best, margin = _best(self._sizes(blocks, 1))
        if margin < self.narrow and self.more:
            best, margin = _best(self._sizes(blocks, DICTIONARIES))
        # Half at no margin; 1 from a tenth of the bytes on.
        return best, min(1.0, 0.5 + 5 * margin), margin < self.narrow


def _compressor(content: bytes) -> Callable[[bytes], bytes]:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
    ).compress


def _best(sizes: dict[str, float]) -> tuple[str, float]:
    """The language of the fewest bytes, and the share it saves against the next one."""
    best, *others = sorted(sizes, key=sizes.get)
    return best, 1 - sizes[best] / max(sizes[others[0]], 1) if others else 1.0


def predict(dictionaries: Dictionaries, narrow: float = NARROW) -> Callable[[Column], Column]:
    """A function from a text column to a struct (lang, score, rejected)."""
    ready: list[Classifier] = []  # one per Python worker and query, made on first use

    @F.pandas_udf("lang string, score double, rejected boolean")
    def classify(texts: pd.Series) -> pd.DataFrame:
        if not ready:
            ready.append(Classifier(dictionaries, narrow))
        return pd.DataFrame([ready[0].predict(text) for text in texts], columns=["lang", "score", "rejected"])

    return classify


def identify(docs: DataFrame, dictionaries: Dictionaries, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for every document."""
    return docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(doc_fold(F.col(key)) == 1, F.lit(False)).alias("held_out"),
        predict(dictionaries)(F.col(text)).alias("found"),
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.rejected")


def keep_identified(docs: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id") -> DataFrame:
    """The documents whose language is not rejected, all columns as they were."""
    known = predict(learn(docs, text, language, key))
    return docs.where(~known(F.col(text))["rejected"])
