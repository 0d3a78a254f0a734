import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from postloom.llm import tokens

ALPHABET = [*" \n\t\x0b\x1c\x1f\x85\xa0aAéß漢😀1²٣Ⅷ!.'_\x00", "\u2003", "\u3000", "\u200b", "'s", "'ll", "<|endoftext|>", "<|end", "|>", "the ", "  "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_counts_equal_the_library_on_random_texts(library):
    draw = random.Random(5)
    counter = tokens.BpeCounter(tokens.DEFAULT_VOCABULARY)
    for _ in range(4_000):
        text = "".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 16)))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_long_words_and_full_memory(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED_WORDS", 3)
    counter = tokens.BpeCounter(tokens.DEFAULT_VOCABULARY)
    for text in ("ab" * 20_000, "z" * 30_000, "one two three four five six one two", "a" + " " * 9_000 + "b"):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_whole_table(shipped, library):
    folder = "/root/testdata/sf0.001"
    from postloom.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] or "" for r in shipped.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op5_token_counts"](shipped, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 1024)


def test_odd_rows(odd_documents, empty_documents, library):
    rows = tokens.token_counts(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert {(r["n_bytes"], r["n_tokens"]) for r in rows if r["doc_id"] in (2, 3)} == {(0, 0)}
    assert tokens.token_counts(empty_documents).count() == 0
