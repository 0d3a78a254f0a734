import math
import zlib

import pytest
from pyspark.sql import functions as F

from postloom.llm import toxicity as tox
from postloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(shipped):
    return tox.learn(shipped.read.parquet(f"{FOLDER}/documents.parquet"), shipped.read.parquet(f"{FOLDER}/labels.parquet"))


def test_held_out_documents(shipped, model):
    docs = shipped.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in shipped.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = tox.judge(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(labels[r["doc_id"]], r["predicted"], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    caught = sum(p for y, p, _ in held if y)
    wrong = sum(p for y, p, _ in held if not y)
    assert caught >= 0.85 * sum(y for y, _, _ in held)
    assert wrong <= 0.02 * sum(1 - y for y, _, _ in held)
    toxic, clean = [s for y, _, s in held if y], [s for y, _, s in held if not y]
    above = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert above >= 0.95


def test_labels_of_held_out_documents_and_other_columns_change_nothing(shipped):
    folder = "/root/testdata/sf0.01"
    docs, labels = (shipped.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    first = QUERIES["op13_toxicity"](shipped, folder).collect()
    flipped = labels.withColumn("toxic", F.abs(labels["toxic"] - (tox.doc_fold(labels["doc_id"]) == 1).cast("int")))
    plain = docs.selectExpr("doc_id", "text", "'x' AS lang", "'x' AS source", "0 AS score", "0 AS toxic", "'e' AS entry")
    assert sorted(tox.judge(plain, tox.learn(plain, flipped)).collect()) == sorted(first)


def machine_kinds(text, insults=("fool",)):
    """The kinds of clauses found, with a lexicon of given insults."""
    lexicon = tox.Lexicon({f"{w}$": (0.0, 1_000.0) for w in insults}, 0.1)
    found = tox.Grammar().features(lexicon[t] for t in tox.tokens(text))
    return {k for k, weight in zip(tox.KINDS, found[1:]) if weight > 0}


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("A fool was here.", {"plain"}),
        ("You utter fool!", {"targeted"}),
        ("A fool of a man ran away", {"plain"}),
        ("What a fool you are", {"targeted"}),
        ("You are not a fool.", {"negated"}),
        ("Not now. You fool", {"targeted"}),
        ("He said the judge was a fool", {"reported"}),
        ("He said it. A fool spoke", {"plain"}),
        ('The word "fool" is old', {"reported"}),
        ('The word "old" is a fool', {"plain"}),
        ("They said you are no fool", {"reported"}),
        ("I will kill you", {"threat"}),
        ("Plants that kill weeds", set()),
        ("I will not kill you", {"negated"}),
        ("Nothing here.", set()),
        ("", set()),
    ],
)
def test_patterns(text, kinds):
    assert machine_kinds(text) == kinds


def test_composition_equals_one_after_the_other():
    one, two = tox.negation(), tox.reported()
    both = tox.compose(one, two)
    symbols = ["insult", "not", "other", "insult", "said", "threat", "end", "quote", "insult", "quote", "insult", "not", "threat"] * 3
    a = b = c = 0
    for s in symbols:
        a, between, w1 = one.step(a, s)
        b, out, w2 = two.step(b, between)
        c, got, w = both.step(c, s)
        assert (got, w) == (out, w1 + w2)


def test_heavier_when_targeted_than_reported(model):
    score = model.scorer()
    assert score("You are an idiot and a moron.") > score("He said an idiot and a moron came.") >= score("He came.")
    assert score("IDIOT!!! Moron$$$ you") >= 0.7 > score("The weather is fine.")


def test_words_of_a_marked_prefix():
    lexicon = tox.Lexicon({"abcd": (2.0, 60.0), "abcdx$": (40.0, 0.0), "abcdy$": (0.0, 30.0)}, 0.1)
    assert lexicon["abcdz"][0] == 1 and lexicon["abcdy"][1] > lexicon["abcdz"][1]
    assert lexicon["abcdx"] == (0, 0.0)  # met often in other documents
    assert lexicon["abce"] == (0, 0.0)


def test_odd_rows(odd_documents, empty_documents, shipped, model):
    rows = tox.judge(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    empty = {r["score"] for r in rows if r["doc_id"] in (2, 3, 4)}
    assert len(empty) == 1 and empty.pop() < 0.7
    assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)
    assert tox.judge(empty_documents, model).count() == 0
    labels = shipped.createDataFrame([(1, None), (None, 1), (3, 1), (3, 1), (5, 0), (6, 0), (2, 1)], "doc_id long, toxic int")
    for some in (labels, labels.where("toxic = 1"), labels.where("false")):
        found = tox.judge(odd_documents, tox.learn(odd_documents, some)).collect()
        assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and not math.isnan(r["score"]) for r in found)


def test_long_texts_read_as_short_ones(model, monkeypatch):
    text = "plain words. " * 50 + "you idiot moron scum! " + "more words; " * 50
    whole = model.scorer()(text)
    monkeypatch.setattr(tox, "_LONG", 10)
    assert model.scorer()(text) == whole
