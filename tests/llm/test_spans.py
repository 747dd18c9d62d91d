"""Repeated sentence spans against a plain loop over all runs."""

import re

from postlake.llm.queries import QUERIES
from postlake.llm.spans import without_repeated_spans, without_sentences

FOLDER = "/root/testdata/sf0.001"


def cut(text):
    out, at = [], 0
    for m in re.finditer(r"[.!?\n]+[ \t\n\r\x0b\x0c]*", text):
        out.append(text[at : m.end()])
        at = m.end()
    return out + ([text[at:]] if at < len(text) else [])


def loop_clean(docs, least_sentences=2, least_words=3):
    """``{doc: (text, sentences, removed)}`` by trying every run of every document."""
    homes, found = {}, []
    for doc, text in sorted(docs):
        parts = cut(text)
        wordy = [(i, p.lower().split()) for i, p in enumerate(parts) if p.split()]
        shortest = set()
        for a in range(len(wordy)):
            for b in range(a + least_sentences, len(wordy) + 1):
                if sum(len(w) for _, w in wordy[a:b]) >= least_words:
                    shortest.add((a, b))
                    break
        for b in range(len(wordy), 0, -1):
            for a in range(b - least_sentences, -1, -1):
                if sum(len(w) for _, w in wordy[a:b]) >= least_words:
                    shortest.add((a, b))
                    break
        for a, b in sorted(shortest):
            words = tuple(w for _, s in wordy[a:b] for w in s)
            place = (doc, wordy[a][0])
            homes[words] = min(homes.get(words, place), place)
            found.append((words, place, wordy[b - 1][0] + 1))
    gone = {doc: set() for doc, _ in docs}
    for words, place, end in found:
        if homes[words] != place:
            gone[place[0]] |= set(range(place[1], end))
    return {
        doc: ("".join(p for i, p in enumerate(cut(t)) if i not in gone[doc]), len(cut(t)), len(gone[doc])) for doc, t in docs
    }


def test_registered_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in QUERIES["op8_repeated_spans"](spark, FOLDER).collect()}
    want = loop_clean([tuple(r) for r in rows])
    assert got == want and any(n for _, _, n in want.values())


def passage(words, stop=13):
    text = [f"p{i}" + ("." if i % stop == stop - 1 else "") for i in range(words)]
    return " ".join(text) + "."


def test_passages_go_from_all_but_the_first(spark):
    shared = passage(55)
    docs = [(i, f"Own text number {i} stands here alone.\n{shared}\nAnd the end of {i} follows.") for i in range(40)]
    docs += [(90, "Oui.\nDes."), (91, "Oui.\nDes."), (92, passage(20)), (93, passage(20)), (94, "Send it. Wait!"), (95, "Send it. Wait!")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, clean string")
    got = {r.row.doc_id: r.clean for r in without_repeated_spans(frame).collect()}
    assert {i: (c.text, c.n_sentences, c.n_removed) for i, c in got.items()} == loop_clean(docs)
    assert shared in got[0].text and got[0].n_removed == 0
    assert all("p0" not in got[i].text and "p54" not in got[i].text and f"number {i}" in got[i].text for i in range(1, 40))
    assert all(got[i].n_removed == 0 for i in (90, 91, 92, 94)) and got[93].text == got[95].text == ""


def test_awkward_rows(spark):
    one = passage(40)
    rows = [
        (1, None), (2, ""), (3, "\n\n..."), (None, one), (4, one.upper()), (5, one + "\n" + one), (5, one + "\n" + one),
        (6, "x. " * 50_000), (7, "no stop at all " * 20),
    ]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, row int")
    got = without_repeated_spans(frame).collect()
    assert len(got) == len(rows)
    by_id = {r.row.doc_id: r.clean for r in got}
    assert by_id[4].n_removed == 0 and by_id[None].text == "" and by_id[1].n_sentences == 0
    assert by_id[5].text == "" and sum(r.row.doc_id == 5 and r.clean.text == "" for r in got) == 2
    assert by_id[7].n_removed == 0 and by_id[6].n_removed > 49_000
    assert without_repeated_spans(frame.limit(0)).collect() == []


def test_removal_keeps_the_rest():
    assert without_sentences(b"A. B! C?\nD", [(1, 2)]) == (b"A. C?\nD", 4, 1)
    assert without_sentences(b"A. B! C?\nD", [(0, 2), (1, 4)]) == (b"", 4, 4)
    assert without_sentences(b"", []) == (b"", 0, 0)
