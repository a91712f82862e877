"""The registered queries: SQL twins, odd rows, scoring by hand."""

import math
import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from test_pipeline import item_words, windows

import checks.compare as compare
from rastro.llm import decontamination, lm
from rastro.llm.queries import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", ORACLES)
def test_sql_twins(spark, sf_dir, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    assert compare.difference(spark, compare.connect(sf_dir), name, sf_dir) is None


def test_every_operator_and_the_pipeline_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def test_entry_works_without_this_package(tmp_path):
    """As after deleting the package and the pipeline: the other queries stay."""
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("rastro.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as e
assert "device_metrics" in e.queries() and "pipeline" not in e.queries()
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, check=False)
    assert done.returncode == 0, done.stderr


def contamination(rows, items):
    known = {}
    for item, text in items:
        for window in windows([text]):
            known.setdefault(window, set()).add(str(item))
    for doc_id, text in rows:
        words = item_words(text)
        hit, found = set(), set()
        for n in {n for n, _ in known}:
            for i in range(len(words) - n + 1):
                match = known.get((n, tuple(words[i : i + n])))
                if match:
                    hit |= set(range(i, i + n))
                    found |= match
        yield doc_id, len(words), len(hit), sorted(found)


@pytest.fixture
def no_broadcasts(spark):
    """Spark broadcasts nothing by its own size check."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_windows_beyond_the_broadcast_are_shuffled_without_their_text(spark, make_docs, no_broadcasts):
    """Bytes shuffled follow the text: rows of the exchange by window have a hash and a place."""
    benchmark = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40)))], "item_id long, text string")
    docs = make_docs([(i, " ".join(f"w{(i * 7 + j) % 90}" for j in range(3_000))) for i in range(6)])
    rows = docs.selectExpr("struct(cast(doc_id AS string) AS id, xxhash64(text) AS hash) AS _key", "text AS _text")
    found = decontamination.find_hits(rows, benchmark, "_text", 0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "words" in plan and "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()
    wide = decontamination.find_hits(rows, benchmark, "_text")
    shown = lambda df: sorted((r._key.id, r.n_hit, tuple(r["items"])) for r in df.collect())
    assert shown(found) == shown(wide) and len(shown(found)) == 6


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_contamination_of_odd_rows(spark, make_docs, no_broadcasts, broadcast_bytes):
    long = " ".join(f"w{i}" for i in range(30))
    items = [(1, long), (2, "Tiny item"), (10, "tiny ITEM"), (3, None), (4, ""), (5, "--"), (None, "ünï 7"), (6, long[:60])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (1, None), (2, ""), (3, f"before {long} after"), (3, f"before {long} after"), (4, "a tiny, ITEM; tiny item!"),
        (None, "Ünï 7 and ünï-7"), (6, " ".join(f"w{i}" for i in range(5, 14))), (7, "tiny " * 50_000 + "item"),
        (8, " ".join(f"w{i % 30}" for i in range(95))),
    ]
    judged = decontamination.judge_contamination(make_docs(rows), benchmark, broadcast_bytes=broadcast_bytes)
    found = Counter((r.row.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in judged.collect())
    named = [(i, t) for i, t in items if i is not None]
    wanted = Counter((d, n, h, tuple(f), h > 0) for d, n, h, f in contamination(rows, named))
    # the item without an id hits, but has no name to list
    wanted[(None, 5, 0, (), False)] -= 1
    wanted[(None, 5, 2, (), True)] += 1
    assert found == +wanted


def test_contamination_without_benchmark(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontamination.contamination_report(make_docs([(1, "a b"), (2, None)]), none)
    assert sorted((r.doc_id, r.n_words, r.n_hit) for r in found.collect()) == [(1, 2, 0), (2, 0, 0)]
    assert decontamination.contamination_report(make_docs([]), none).count() == 0


def scores(texts, order, backoff=0.4):
    """Stupid backoff by dictionaries, each text scored by the others."""
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    grams = [Counter(tuple(d[i : i + n]) for n in range(1, order + 1) for i in range(len(d) - n + 1)) for d in docs]
    corpus = sum(grams, Counter())
    total = sum(map(len, docs))
    for words, own in zip(docs, grams):
        logs = []
        for i in range(len(words)):
            longest = min(i + 1, order)
            score = backoff**longest / (total - len(words) + 1)
            for n in range(longest, 0, -1):
                gram = tuple(words[i - n + 1 : i + 1])
                if corpus[gram] > own[gram]:
                    rest = total - len(words) if n == 1 else corpus[gram[:-1]] - own[gram[:-1]]
                    score = (corpus[gram] - own[gram]) / rest * backoff ** (longest - n)
                    break
            logs.append(math.log(score))
        yield sum(logs) / len(logs) if logs else None


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_match_dictionaries(make_docs, monkeypatch, order):
    texts = [None, "", " \n", "a", "a b a b a", "a b c", "a b c d a b", "zzz yyy", "b c d " * 40, "b c d"]
    rows = list(enumerate(texts)) + [(9, "b c d"), (None, "a\tb\x0bc")]
    found = lm.score_documents(make_docs(rows), order=order).collect()
    wanted = Counter((d, None if s is None else round(s, 9)) for (d, _), s in zip(rows, scores([t for _, t in rows], order)))
    assert Counter((r.doc_id, None if r.score is None else round(r.score, 9)) for r in found) == wanted


def test_scores_of_nothing(make_docs):
    assert lm.score_documents(make_docs([])).count() == 0
    (alone,) = lm.score_documents(make_docs([(1, "one two")])).collect()
    assert alone.score == pytest.approx((math.log(0.4) + 2 * math.log(0.4)) / 2)
