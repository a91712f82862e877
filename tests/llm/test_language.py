"""Automata and parses against brute force; held-out accuracy."""

import random
import zlib

import numpy as np

from rastro.llm import language


def brute_phrases(sample, text):
    """Greedy longest matches by substring search."""
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample and text[at : at + size] in sample:
            size += 1
        count, at = count + 1, at + size
    return count


def test_phrases_match_brute_force():
    rng = random.Random(4)
    sample = bytes(rng.choice(b"abcab c") for _ in range(400))
    folded = language.fold(np.frombuffer(sample, np.uint8))
    table = language.suffix_automaton(folded, 155)
    texts = [bytes(rng.choice(b"abcd b") for _ in range(n)) for n in (0, 1, 2, 17, 300, 301)]
    folds = [language.fold(np.frombuffer(t, np.uint8)) for t in texts]
    sizes = np.array([len(f) for f in folds])
    joined = np.concatenate([*folds, np.zeros(1, np.uint8)])
    found = language.count_phrases(table, joined, np.cumsum(sizes) - sizes, sizes)
    assert found.tolist() == [brute_phrases(folded.tobytes(), f.tobytes()) for f in folds]


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    found = {r.doc_id: r for r in language.language_report(docs).collect()}
    rows = docs.select("doc_id", "text", "lang").collect()
    assert len(found) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in held} == {d for d, r in found.items() if r.held_out}
    labelled = [r for r in held if r.lang and r.text]
    assert sum(found[r.doc_id].lang_pred == r.lang for r in labelled) >= 0.98 * len(labelled)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_defined_results(make_docs):
    docs = make_docs(
        [(i, "der die das und ist nicht " * 9, "de") for i in range(20)]
        + [(100 + i, "the of and is that with " * 9, "en") for i in range(20)]
        + [(200, None, "en"), (201, "", "en"), (202, "12 + 3!", "de"), (None, "the of and", None)]
        + [(203, "und nicht das " * 5000, None), (203, "und nicht das " * 5000, None)]
    )
    found = language.language_report(docs).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == 46
    assert [by_id[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3
    assert by_id[200].score == 0 and by_id[None].lang_pred == "en" and by_id[203].lang_pred == "de"
    assert by_id[None].held_out is False
    unlabelled = make_docs([(1, "some text", None)])
    assert language.language_report(unlabelled).first().lang_pred == "und"
    assert language.language_report(make_docs([])).count() == 0
