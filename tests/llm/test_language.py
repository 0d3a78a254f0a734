import zlib

import pytest
import regex
import zstandard
from pyspark.sql import functions as F

from postloom.llm import language
from postloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def found(shipped):
    rows = QUERIES["op4_language_id"](shipped, FOLDER).collect()
    truth = {r["doc_id"]: r for r in shipped.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    return rows, truth


def test_held_out_accuracy(found):
    rows, truth = found
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth)
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_few_are_rejected_and_only_short_ones(found):
    rows, truth = found
    rejected = [r for r in rows if r["rejected"]]
    assert len(rejected) <= 0.02 * len(rows)
    assert sorted(len(truth[r["doc_id"]]["text"]) for r in rejected)[: -2 or None][-1] < 100


def plain_predict(dictionaries, text):
    """The smallest zstandard size over raw-content dictionaries, written out."""
    letters = "".join(c if c.isalpha() or regex.match(r"\p{M}", c) else " " for c in (text or "").lower())
    content = " ".join(letters.split()).encode("utf-8", "replace")
    if not any(map(str.isalpha, text or "")):
        return "und", 0.0, True

    def size(dictionary):
        raw = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packer = zstandard.ZstdCompressor(level=6, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)
        return sum(len(packer.compress(content[i : i + 4_096])) for i in range(0, len(content), 4_096))

    def best(count):
        sizes = sorted((sum(map(size, d[:count])) / len(d[:count]), i, lang) for i, (lang, d) in enumerate(dictionaries.items()))
        return sizes[0][2], 1 - sizes[0][0] / sizes[1][0]

    lang, margin = best(1)
    if margin < 0.002:
        lang, margin = best(4)
    return lang, min(1.0, 0.5 + 5 * margin), margin < 0.002


def test_every_text_equals_a_plain_classification(shipped):
    docs = shipped.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id % 20 = 0")
    known = language.learn(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    short = docs.withColumn("text", F.substring("text", 1, 25))
    for frame, text_of in ((docs, lambda t: t), (short, lambda t: t[:25])):
        for r in language.identify(frame, known).collect():
            lang, score, rejected = plain_predict(known, text_of(texts[r["doc_id"]]))
            assert (r["lang_pred"], r["rejected"]) == (lang, rejected) and r["score"] == pytest.approx(score)


def test_predictions_ignore_all_but_the_text(documents):
    rows = [(i, f"{w} " * 40, lang, "s") for i, (w, lang) in enumerate([("der die das und", "de"), ("the and of to", "en")] * 12)]
    known = language.learn(documents(rows))
    assert set(known) == {"de", "en"}
    other = documents([(1, "the and of to the and of to", "de", "x"), (4, "the and of to the and of to", None, None)])
    found = {(r["lang_pred"], r["score"], r["rejected"]) for r in language.identify(other, known).collect()}
    assert len(found) == 1 and found.pop()[0] == "en"


def test_held_out_documents_are_not_learned(documents):
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert language.learn(documents([(i, "nur deutsche texte hier im wald", "de", "s") for i in held])) == {}


def test_odd_rows(odd_documents, empty_documents):
    rows = language.identify(odd_documents, language.learn(odd_documents)).collect()
    assert len(rows) == odd_documents.count()
    unknown = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert {2, 3, 4, 5} <= unknown
    assert all(r["score"] == 0 and r["rejected"] for r in rows if r["lang_pred"] == "und")
    assert all(not r["held_out"] for r in rows if r["doc_id"] is None)
    assert language.identify(empty_documents, language.learn(empty_documents)).count() == 0
    assert language.keep_identified(empty_documents).columns == empty_documents.columns


def test_a_language_of_one_document_does_not_change_the_others(shipped):
    """Texts whose margin is narrow over the first dictionaries are decided by the further ones all the same."""
    docs = shipped.read.parquet(f"{FOLDER}/documents.parquet")
    known = language.learn(docs)
    stray = known | {"zz": [b"qxzzkw vvjqx zzkq xwvj " * 4]}
    without, among = language.Classifier(known), language.Classifier(stray)
    texts = [" ".join(r["text"].split()[:n]) for r in docs.limit(300).collect() for n in (1, 2, 3)]
    first_only = [language.Classifier({lang: each[:1] for lang, each in known.items()}).predict(text) for text in texts[:300]]
    given = [without.predict(text) for text in texts]
    assert [among.predict(text)[0] for text in texts] == [g[0] for g in given]
    # A stray language can be the runner-up, so margins may shrink, but texts that were decided stay so.
    assert sum(among.predict(text)[2] for text in texts) <= sum(g[2] for g in given) + 0.01 * len(texts)
    assert sum(g[2] for g in given[:300]) < sum(f[2] for f in first_only)
