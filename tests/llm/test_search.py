"""Ranked search: brute force over every document, bounds and accumulators, odd rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from test_pipeline import item_words

from rastro.llm import search as S


def ranked(docs, queries, k=10):
    """Scores of all documents by their definition."""
    counted = [(doc_id, Counter(item_words(text))) for doc_id, text in docs]
    counted = [(doc_id, terms, terms.total()) for doc_id, terms in counted if terms]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, terms, _ in counted for t in terms)
    for item_id, text in dict.fromkeys(queries):
        scores = []
        for doc_id, terms, n in counted:
            m, score = 25 + 75 * n * n_docs // n_terms, 0
            for t, times in Counter(item_words(text)).items():
                if tf := terms[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scores)[:k], 1):
            yield item_id, rank, doc_id, -score


QUERIES = [(1, "a B c"), (2, "zebra"), (3, "the the the cat"), (4, None), (5, ""), (6, "--"), (7, "ünï Ünï x7"), (1, "a B c"),
           (None, "cat"), (8, "dog the"), (8, "cat dog")]
DOCS = [
    (1, None), (2, ""), (3, "a b c"), (4, "A-B-C"), (4, "A-B-C"), (None, "a b c"), (5, "the cat; the dog"), (6, "the " * 5000),
    (7, "cat " * 300 + "the"), (8, "ünï Ünï"), (-9, "dog dog dog"), (10, "x7 x7 a"), (2**62, "Cat"),
]


@pytest.mark.parametrize("query_bytes", [S.QUERY_BYTES, 60])
def test_search_matches_brute_force(spark, make_docs, query_bytes):
    docs = make_docs(DOCS).repartition(3)
    queries = spark.createDataFrame(QUERIES, "item_id long, text string")
    found = S.search(docs, queries, k=3, query_bytes=query_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == Counter(ranked(DOCS, QUERIES, 3))


def test_search_of_many_ties_over_several_tasks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(S, "MERGED_LISTS", 2)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices("abcdefghij", [2**j for j in range(10)], k=rng.choice([3, 3, 30])))) for i in range(900)]
    rows += [(i, "a copy of many words a b") for i in range(2000, 2600)]
    rng.shuffle(rows)
    queries = [(i, " ".join(rng.choices("abcdefghijxyz", k=5))) for i in range(12)] + [(99, "a copy")]
    found = S.search(make_docs(rows).repartition(7), spark.createDataFrame(queries, "item_id long, text string"))
    assert Counter(map(tuple, found.collect())) == Counter(ranked(rows, queries))


def test_no_accumulators_after_the_bound():
    """A common term neither creates accumulators that cannot win nor is left out of those that exist."""
    begins = np.array([0, 2, 6])
    docs, parts = np.array([0, 1, 0, 1, 2, 3]), np.array([900, 800, 5, 6, 9, 9])
    scores = S.accumulate([(0, 10), (1, 1)], (begins, docs, parts), [900, 9], 4, k=2, least=0)
    assert scores.tolist() == [9005, 8006, 0, 0]
    # three are asked for, so the common term must still create
    scores = S.accumulate([(0, 10), (1, 1)], (begins, docs, parts), [900, 9], 4, k=3, least=0)
    assert scores.tolist() == [9005, 8006, 9, 9]
    # a bound that just reaches the least score still counts, because ids tell equal scores apart
    scores = S.accumulate([(1, 1)], (begins, docs, parts), [900, 9], 4, k=1, least=9)
    assert scores.tolist() == [5, 6, 9, 9]
    assert not S.accumulate([(1, 1)], (begins, docs, parts), [900, 9], 4, k=1, least=10).any()


def test_search_of_nothing(spark, make_docs):
    queries = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert S.search(make_docs([]), queries).count() == 0
    assert S.search(make_docs([(1, "a"), (2, "b")]), queries.limit(0)).count() == 0
    assert [tuple(r) for r in S.search(make_docs([(1, "a"), (2, "b")]), queries).collect()] == [(1, 1, 1, 693 * 555_555)]


def test_search_ignores_other_columns(spark, make_docs):
    """Columns with names that the operator uses itself do not clash."""
    docs = make_docs([(1, "a"), (2, "b")]).selectExpr("*", "1 AS score", "'x' AS item_id", "2 AS rank", "3 AS data", "4 AS query")
    queries = spark.createDataFrame([(1, "a", 5, 6)], "item_id long, text string, doc_id long, score long")
    assert [r.doc_id for r in S.search(docs, queries).collect()] == [1]
