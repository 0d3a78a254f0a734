import random

import pytest

from postloom.llm import lines
from postloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain(docs):
    """Texts after removal by one pass in rank order over all units."""
    seen, gone = {}, {}
    ranked = sorted(docs, key=lambda d: (d["doc_id"] is None, d["doc_id"] or 0))
    for n, d in enumerate(ranked):
        for number, (start, end) in enumerate(lines.cut(d["text"]) if d["text"] else []):
            found = lines.digest(d["text"][start:end])
            place = (d["doc_id"], d["text"], number)
            if found is not None and seen.setdefault(found, place) != place:
                gone.setdefault(n, set()).add(number)
    return [(d["doc_id"], d["text"], lines.removed_spans(d["text"], gone.get(n, set())) if d["text"] else []) for n, d in enumerate(ranked)]


def check(rows, docs):
    found = sorted((r["doc_id"], r["text"], [(s["start"], s["end"]) for s in r["removed"]]) for r in rows)
    expected = []
    for i, text, spans in plain(docs):
        kept, at = "", 0
        for start, end in spans:
            kept += text[at:start]
            at = end
        expected.append((i, None if text is None else kept + text[at:], spans))
    assert found == sorted(expected)


def test_whole_table_equals_brute_force(shipped):
    docs = shipped.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = QUERIES["op8_line_dedup"](shipped, FOLDER).collect()
    check(rows, docs)
    assert all(r["removed_chars"] == sum(s["end"] - s["start"] for s in r["removed"]) for r in rows)


def test_planted_passages_go_and_clean_texts_stay(documents):
    draw = random.Random(1)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9))) for _ in range(3_000)]

    def sentence():
        return " ".join(draw.choice(vocabulary) for _ in range(draw.randint(9, 14))).capitalize() + "."

    def paragraph(n):
        return " ".join(sentence() for _ in range(n))

    passage = paragraph(6)
    clean = [(i, paragraph(8) + "\n" + paragraph(5), "en", "s") for i in range(30)]
    planted = [(100 + i, paragraph(3) + f"\n{passage}\n" + paragraph(3), "en", "s") for i in range(4)]
    inside = [(200 + i, paragraph(3) + " " + passage + " " + paragraph(2), "en", "s") for i in range(3)]
    frame = documents(clean + planted + inside)
    found = {r["doc_id"]: r for r in lines.deduplicate(frame).collect()}
    given = {r["doc_id"]: r["text"] for r in frame.collect()}
    for i, _, _, _ in clean:
        assert found[i]["text"] == given[i]
    assert found[100]["text"] == given[100]
    for i in [101, 102, 103, 200, 201, 202]:
        assert passage not in found[i]["text"] and passage[:40] not in found[i]["text"]
        gone = "".join(given[i][s["start"] : s["end"]] for s in found[i]["removed"])
        assert gone.strip() in passage and len(gone.split()) >= len(passage.split()) - 2 * lines.MIN_WORDS
        if i < 200:
            assert gone.strip() == passage


def test_passages_without_sentences_fall_into_step(documents):
    draw = random.Random(9)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9))) for _ in range(3_000)]

    def words(n):
        return [draw.choice(vocabulary) for _ in range(n)]

    passage = words(60)
    rows = [(i, " ".join([*words(20 + 3 * i), *passage, *words(30)]), "en", "s") for i in range(20)]
    found = {r["doc_id"]: r["removed"] for r in lines.deduplicate(documents(rows)).collect()}
    assert not found[0]
    gone = [sum(len(rows[i][1][s["start"] : s["end"]].split()) for s in found[i]) for i in range(1, 20)]
    assert min(gone) >= 10 and sum(gone) >= 19 * 30
    assert all(" ".join(rows[i][1][s["start"] : s["end"]].split()) in " ".join(passage) for i in range(1, 20) for s in found[i])


def test_short_units_go_only_between_removed_ones():
    line = "a b c d e f g h. Yes. i j k l m n o p. No. q r s t u v w x."
    units = lines.cut(line)
    assert lines.removed_spans(line, {0, 2}) == [(0, units[2][1])]
    assert lines.removed_spans(line, {0}) == [units[0]]
    assert lines.removed_spans(line, {0, 2, 4}) == [(0, len(line))]
    assert lines.removed_spans("one two. three", set()) == []


@pytest.mark.parametrize("text", ["", "a", "a.b. c\n\nd!? e", "\n", "... ...", "x y. z\r\n"])
def test_units_cover_the_text(text):
    assert "".join(text[s:e] for s, e in lines.cut(text)) == text


def test_odd_rows(odd_documents, empty_documents):
    docs = odd_documents.collect()
    rows = lines.deduplicate(odd_documents).collect()
    assert len(rows) == len(docs)
    by_id = [(r["doc_id"], r["text"]) for r in rows]
    assert (2, None) in by_id and (3, "") in by_id and by_id.count((1, docs[0]["text"])) == 2
    assert lines.without_repeats(odd_documents.drop("removed")).columns == odd_documents.drop("removed").columns
    assert lines.without_repeats(empty_documents).count() == 0


def test_repeated_lines_of_short_sentences_and_short_lines_go_whole(documents):
    repeated = ["Home | About | Contact", "Yes. No. Of course not. Go on. And so it went. Then.", "  Read more  ", "One. Two three."]
    rows = [(i, f"foreign words {i}\n" + "\n".join(repeated) + f"\nlast words {i}\nThe end", "en", "s") for i in range(5)]
    rows += [(10, "Well. home | about | CONTACT", "en", "s"), (11, "The end", "en", "s")]
    found = {r["doc_id"]: r["text"] for r in lines.deduplicate(documents(rows)).collect()}
    assert found[0] == rows[0][1]
    # Two words by themselves are no copy; next to lines that go they go too.
    assert found[11] == "The end"
    assert all(found[i] == f"foreign words {i}\nlast words {i}\nThe end" for i in range(1, 5))
    assert found[10] == rows[5][1]  # a short part of a line is no line


def test_short_lines_go_with_their_neighbours():
    text = "Of.\nthe whole line of four\nOf.\nto stay here\nOf.\nAnd.\nyes\nno\nx y z\n"
    units = [text[a:b] for a, b in lines.cut(text)]
    gone = {n for n, u in enumerate(units) if u not in ("to stay here\n", "x y z\n")}
    spans = [text[a:b] for a, b in lines.removed_spans(text, gone)]
    assert spans == ["Of.\nthe whole line of four\nOf.\n", "Of.\nAnd.\nyes\nno\n"]
    assert lines.removed_spans(text, {2}) == [] and lines.removed_spans(text, {4, 5, 6}) == []


def test_passages_of_short_sentences_inside_lines_go(documents):
    passage = " ".join(f"Short one {i}." for i in range(20))
    rows = [(i, f"Foreign start number {i} goes before the passage of this test. {passage} Other end {i}.", "en", "s") for i in range(4)]
    found = {r["doc_id"]: r["text"] for r in lines.deduplicate(documents(rows)).collect()}
    assert found[0] == rows[0][1]
    assert all(len(found[i].split()) <= len(rows[i][1].split()) - 50 for i in range(1, 4))


def test_a_short_part_of_a_line_is_told_from_a_whole_line():
    for text in ["Yes. a b c d e f g h.", "a b c d e f g h. Yes.", "a b c d e f g h. Yes.\nx", " Yes. a b c d e f g h."]:
        assert sum(lines.digest(text[s:e]) is not None for s, e in lines.cut(text)) == 1 + text.endswith("x")
    for text in ["Yes.", " Yes.", "Yes. ", "\tYes.\r\n", "Yes. "]:
        assert [lines.digest(text[s:e]) for s, e in lines.cut(text) if text[s:e].strip()] == [lines.digest("yes.")]


def test_text_without_spaces(documents):
    draw = random.Random(4)

    def characters(n, low=0x4E00, high=0x5200):
        return "".join(chr(draw.randrange(low, high)) for _ in range(n))

    repeated = [characters(240), characters(12), "".join(characters(9) + "。" for _ in range(8)), characters(90, 0x0E01, 0x0E2F), "QUJD" * 60]
    passage = characters(240)
    rows = [(i, characters(20) + "\n" + "\n".join(repeated) + "\n" + characters(30), "zh", "s") for i in range(4)]
    inside = [(10 + i, characters(30 + 7 * i) + passage + characters(40), "zh", "s") for i in range(8)]
    given = {r[0]: r[1] for r in rows + inside}
    found = {r["doc_id"]: r["text"] for r in lines.deduplicate(documents(rows + inside)).collect()}
    assert found[0] == given[0] and found[10] == given[10]
    for i in range(1, 4):
        first, *_, last = given[i].split("\n")
        assert found[i] == first + "\n" + last
    left = [len(found[10 + i]) - (len(given[10 + i]) - len(passage)) for i in range(1, 8)]
    assert max(left) < len(passage) and sum(left) <= 7 * 0.5 * len(passage)


def test_short_parts_without_spaces_join_a_neighbour():
    text = "好。" + "今天天气很好我们去" * 6 + "。" + "是。" + "明天下雨他们在家里" * 6 + "。对。"
    units = lines.cut(text)
    assert "".join(text[s:e] for s, e in units) == text and len(units) > 1
    assert all(lines.digest(text[s:e]) for s, e in units)
