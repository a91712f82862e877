"""The pipeline stage by stage against brute force on the test tables."""

import re
from collections import Counter

import corpus_pipeline
import pytest
import tiktoken
from test_native import base_personal, base_secrets, quality_counts  # noqa: F401
from test_simhash import components, fingerprint

from rastro.llm import bpe


def windows(benchmark):
    found = set()
    for text in benchmark:
        words = item_words(text)
        if words:
            n = min(len(words), 10)
            found |= {(n, tuple(words[i : i + n])) for i in range(len(words) - n + 1)}
    return found


def item_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


@pytest.fixture(scope="module")
def stages(spark, sf_dir, documents, tmp_path_factory):
    """The rows after each stage."""
    docs, found = documents, [documents.collect()]
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        found.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents.columns
    return found


def test_quality_stage(stages, spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1]}
    for r in stages[0]:
        counts = quality_counts(r.text or "")
        if counts[0] < 10 or 100 * counts[4] > 20 * counts[0]:
            assert r.doc_id not in kept
        elif labels.get(r.doc_id) == 1:
            assert r.doc_id in kept
        elif labels.get(r.doc_id) == 0:
            assert r.doc_id not in kept


def test_dedup_stage(stages):
    prints = {r.doc_id: fingerprint(r.text) for r in stages[1]}
    least = components(prints)
    assert Counter(stages[2]) == Counter(r for r in stages[1] if least[r.doc_id] == r.doc_id)


def test_decontamination_stage(stages, spark, sf_dir):
    known = windows(r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect())
    lengths = {n for n, _ in known}

    def hit(text):
        words = item_words(text)
        return any((n, tuple(words[i : i + n])) in known for n in lengths for i in range(len(words) - n + 1))

    assert Counter(stages[3]) == Counter(r for r in stages[2] if not hit(r.text))


def test_secrets_stage(stages):
    after = {r.doc_id: r for r in stages[4]}
    assert len(stages[3]) == len(stages[4])
    for r in stages[3]:
        text, at, out = r.text, 0, []
        for _, start, stop in base_secrets(text):
            if start >= at:
                out += [text[at:start], "[SECRET]"]
            at = max(at, stop)
        out.append(text[at:])
        assert after[r.doc_id].text == "".join(out)
        assert after[r.doc_id].n_chars == len("".join(out))


def test_encoding_stage(stages):
    with open(corpus_pipeline.VOCABULARY, "rb") as file:
        ranks = bpe.Vocabulary.from_tiktoken(file.read()).ranks
    library = tiktoken.Encoding("own", pat_str=corpus_pipeline.public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in stages[4]}
    assert len(stages[5]) == len(texts)
    for r in stages[5]:
        assert r.round_trip and r.ids == library.encode_ordinary(texts[r.doc_id])


def test_run(spark, sf_dir, stages):
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()) == Counter(r.doc_id for r in stages[5])


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows_and_clashing_names(spark, sf_dir, make_docs, name, stage):
    text = "the quick brown words of a text that is long enough to be kept by all of the rules " * 3
    docs = make_docs([(1, text), (1, text), (None, None), (2, ""), (None, "word")])
    names = ("row", "kept", "quality", "n_words", "items", "label", "ids", "decoded", "_print", "_at", "hash", "span")
    odd = docs.selectExpr("*", *[f"{i} AS {n}" for i, n in enumerate(names)])
    rows = stage(spark, odd, sf_dir)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert rows.columns == odd.columns
    assert rows.count() <= 5
    assert stage(spark, odd.limit(0), sf_dir).count() == 0
