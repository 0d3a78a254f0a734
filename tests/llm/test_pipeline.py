from collections import Counter

import corpus_pipeline
from postloom.llm import language, lines, mixing
from test_lines import plain as plain_lines
from test_minhash import plain as plain_components

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_brute_force(shipped):
    docs = shipped.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    known = language.Classifier(language.learn(docs))
    expected = sorted((r for r in docs.collect() if not known.predict(r["text"])[2]), key=lambda r: r["doc_id"])
    stages = dict(corpus_pipeline.STAGES)

    found = stages["language_id"](shipped, docs, FOLDER)
    assert found.columns == columns and sorted(found.collect(), key=lambda r: r["doc_id"]) == expected

    components = plain_components([(r["doc_id"], r["text"]) for r in expected], 5)
    kept = {i for i, _, least in components if i == least}
    found = stages["minhash_near_dedup"](shipped, found, FOLDER)
    expected = [r for r in expected if r["doc_id"] in kept]
    assert found.columns == columns and sorted(found.collect(), key=lambda r: r["doc_id"]) == expected

    found = stages["line_dedup"](shipped, found, FOLDER)
    texts = {}
    for i, text, spans in plain_lines(expected):
        for start, end in reversed(spans):
            text = text[:start] + text[end:]
        texts[i] = text
    rows = found.collect()
    assert found.columns == columns and {r["doc_id"]: r["text"] for r in rows} == texts
    assert all(r["n_chars"] == len(r["text"]) for r in rows)

    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(found).collect() if r["copies"]}
    mixed = stages["source_mix"](shipped, found, FOLDER)
    assert mixed.columns == columns and Counter(r["doc_id"] for r in mixed.collect()) == copies

    encoded = stages["sentencepiece"](shipped, mixed, FOLDER).collect()
    assert all(r["round_trip"] for r in encoded)
    assert {i: n for i, n in Counter(r["doc_id"] for r in encoded if r["sample"] == 1).items()} == copies
    assert sorted(map(str, corpus_pipeline.run(shipped, FOLDER).collect())) == sorted(map(str, encoded))


def test_stages_on_odd_and_empty_tables(shipped, odd_documents, empty_documents):
    for docs in (odd_documents, empty_documents):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(shipped, docs, FOLDER)
            assert found.columns == docs.columns
            docs = found
        assert corpus_pipeline.STAGES[-1][1](shipped, docs, FOLDER).count() >= 0
    assert lines.without_repeats(odd_documents).columns == odd_documents.columns
