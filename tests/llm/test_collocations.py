import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from postloom.llm import collocations as co


def plain(rows, least=10, first=2_000):
    counts, words = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            counts.update((lang, *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    kept = {g: f for g, f in counts.items() if f >= least}
    found = {}
    for g, a in kept.items():
        lang, w = g[0], g[1:]
        if len(w) < 2:
            continue
        longer = [f for h, f in kept.items() if h[0] == lang and len(h) == 4 and len(w) == 2 and w in (h[1:3], h[2:4])]
        if any(100 * f >= 50 * a for f in longer):
            continue
        cuts = [(counts[lang, *w[:k]], counts[lang, *w[k:]]) for k in range(1, len(w))]
        score, _, l, r = min((10**6 * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted(
        (lang, i, p.decode(), -a, l, r, words[lang], -s) for lang, ps in found.items() for i, (s, a, p, l, r) in enumerate(sorted(ps)[:first], 1)
    )


def check(documents, texts, **options):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate(texts)]
    found = co.collocations(documents(rows), **options)
    got = sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == plain(texts, **options)
    return got


@pytest.fixture(scope="module")
def texts():
    draw = np.random.default_rng(8)
    words = ["New", "York", "city", "the", "Été", "naïve", "x", "of", "a-b", " ", "ñ", "東京"] + [f"w{i}" for i in range(30)]
    weights = 1 / np.arange(1, len(words) + 1)
    marks = [" ", " ", " ", "  ", "\t", " ", ", ", ".", "!\n", " ; ", "\r\n", "\x0b"]
    rows = []
    for i in range(150):
        picks = draw.choice(len(words), size=60, p=weights / weights.sum())
        rows.append(("".join(words[p] + str(draw.choice(marks)) for p in picks), ["en", "de", None, "und"][i % 4]))
    # A hot phrase, many copies, and a phrase inside a longer one only.
    rows += [("every single time. every single time", "en")] * 60 + [("one two", "fr")] * 12 + [("three four five", "fr")] * 9
    return rows + [(None, "en"), ("", None), ("...", "en"), ("solo", "xx"), (" \t ", "de"), ("a a a a a a a a a a a a a", "aa")]


def test_small_tables(documents, texts):
    assert len(check(documents, texts)) > 50
    check(documents, texts, least=4, first=7)
    assert check(documents, [(None, None), ("", "en")]) == []
    assert check(documents, []) == []


@pytest.mark.parametrize("map_bits", [8, 1 << 20])
def test_small_chunks_summaries_and_maps(documents, texts, monkeypatch, map_bits):
    """The same result with texts cut in chunks, summaries that must give up counts, and a crowded map."""
    long = " ".join(f"w{i % 97} v{i % 89}" + "." * (i % 5 == 0) for i in range(3_000))
    rows = [*texts, (long, "en"), (long.replace(".", ""), "de")]
    wanted = plain(rows)
    monkeypatch.setattr(co, "CHUNK_BYTES", 300)
    monkeypatch.setattr(co, "MERGED", 500)
    monkeypatch.setattr(co, "MASS_PER_PART", 2_000)
    monkeypatch.setattr(co, "COUNTERS", 60)
    monkeypatch.setattr(co, "MAP_BITS", map_bits)
    docs = documents([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)])
    batch = pa.RecordBatch.from_pylist([{"lang": lang, "text": t} for t, lang in rows])
    assert sum(len(g.first) for g, _ in co.chunks(batch)) == sum(
        max(0, len(p.split()) - k) for t, _ in rows for p in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").replace(" ", "_")) for k in range(3)
    )
    assert sorted(tuple(r) for r in co.collocations(docs).collect()) == wanted


def test_summaries_keep_every_frequent_key():
    draw = np.random.default_rng(2)
    for capacity in (5, 50, 500):
        keys = draw.zipf(1.2, size=30_000) % 5_000
        for halves in (1, 7):
            summary = co.Summary(10, capacity)
            for part in np.array_split(keys, 20 * halves):
                summary.add(*[x.astype(t) for x, t in zip(np.unique(part, return_counts=True), ("u4", "i8"))])
            true = Counter(keys.tolist())
            found = set(summary.survivors().tolist())
            assert {k for k, n in true.items() if n >= 10} <= found <= {k for k, n in true.items() if n >= 5}
            assert summary.error <= 5 and len(summary.keys) <= summary.capacity


def test_equal_first_hashes_are_told_apart(monkeypatch):
    texts = pa.RecordBatch.from_pylist([{"lang": "x", "text": "a b a b c"}])
    split = co.split
    def blind(*args):
        grams = split(*args)
        grams.hashes[0][:] = np.uint64(1)
        return grams
    monkeypatch.setattr(co, "split", blind)
    everything = SimpleNamespace(value=np.full(1, 255, dtype=np.uint8))
    rows = [r for b in co._count(1, 8, everything)(iter([texts])) for r in b.to_pylist()]
    assert {r["phrase"]: r["n"] for r in rows if r["size"] == 1} == {"a": 2, "b": 2, "c": 1}
    assert {r["phrase"]: r["n"] for r in rows if r["size"] == 2} == {"a b": 2, "b a": 1, "b c": 1}
