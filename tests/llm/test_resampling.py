"""Importance resampling: scores and ranks by their definition, the radix sort on many keys, odd rows."""

import hashlib
import math
import random
from collections import Counter
from zlib import crc32

import pytest
from test_pipeline import item_words

from rastro.llm import resampling as R

SCHEMA = "doc_id long, text string"


def features(text):
    words = item_words(text)
    return [crc32(" ".join(f).encode()) % R.BUCKETS for f in [(w,) for w in words] + list(zip(words, words[1:]))]


def expected(docs, target):
    """(doc_id, n_features, weight, score, rank) per document."""
    s, t = (Counter(f for text in side for f in features(text)) for side in ([text for _, text in docs], target))
    all_s, all_t = s.total() + R.BUCKETS, t.total() + R.BUCKETS
    gain = {f: math.floor(1000 * math.log((t[f] + 1) * all_s / ((s[f] + 1) * all_t))) for f in s}
    rows = []
    for place, (doc_id, text) in enumerate(docs):
        own = features(text)
        weight = sum(gain[f] for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([doc_id, len(own), weight, score, None, len(item_words(text)) >= 20, place])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[6]))
    for rank, row in enumerate(able[: 25 * len(able) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def some_texts(n, seed):
    rng = random.Random(seed)
    words = "alpha Beta gamma ünï 7 x7 the of and".split()
    return [" ".join(rng.choices(words, k=rng.randint(15, 40))) for _ in range(n)]


@pytest.mark.parametrize("block_rows", [R.BLOCK_ROWS, 3])
def test_ranks_match_definition(spark, make_docs, block_rows, monkeypatch):
    ids = [None, None, -(2**63), 2**63 - 1, -1, 0, 5, 5, 5, *range(100, 160)]
    texts = some_texts(len(ids), 1)
    rows = [*zip(ids, texts), (200, None), (201, ""), (202, "-- ;"), (203, "word"), (204, "long " * 60_000), (205, texts[9]),
            *[(300 + i, texts[10]) for i in range(30)]]
    target = ["alpha beta alpha beta", None, "", "of THE of the x7"]
    if block_rows == 3:
        monkeypatch.setattr(R.radix_sorted, "__defaults__", (3,))
    found = R.resampling_report(make_docs(rows).repartition(5), spark.createDataFrame([(1, t) for t in target], SCHEMA))
    found = Counter(map(tuple, found.collect()))
    wanted = expected(rows, target)
    # rows with equal id and score (none here but equal ids) rank as they were read, which repartition changes
    assert found == wanted


def test_equal_rows_have_ranks_of_their_own(spark, make_docs):
    rows = [(7, "w " * 30)] * 9 + [(8, "w " * 30)] * 3
    found = R.resampling_report(make_docs(rows), spark.createDataFrame([(1, "w")], SCHEMA)).collect()
    best = min(r.doc_id for r in found if r.score == max(r.score for r in found))
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3] and {r.doc_id for r in found if r["rank"]} == {best}


def test_radix_sort_is_stable_over_many_digits(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice([0, 1, 5, 4095, 4096, 2**40, 2**63 - 1]), rng.randrange(3), i) for i in range(2000)]
    spark.createDataFrame(rows, "a long, b long, i long").coalesce(1).write.parquet(str(tmp_path / "rows"))
    from pyspark.sql import functions as F

    written = spark.read.parquet(str(tmp_path / "rows"))
    digits = R._digits(F.col("a"), 0, 2**63 - 1) + R._digits(F.col("b"), 0, 2)
    found = R.radix_sorted(written, digits, len(rows), block_rows=100).orderBy("pos").collect()
    assert [r.pos for r in found] == list(range(len(rows)))
    assert [r.i for r in found] == [i for _, _, i in sorted(rows, key=lambda r: (r[1], r[0]))]


def test_nothing_to_rank(spark, make_docs):
    target = spark.createDataFrame([], SCHEMA)
    assert R.resampling_report(make_docs([]), target).count() == 0
    (row,) = R.resampling_report(make_docs([(3, "a b")]), target).collect()
    assert (row.n_features, row["rank"]) == (3, None)


def test_drawn_rows_come_back_whole(spark, make_docs):
    texts = some_texts(40, 5)
    docs = make_docs([(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (50, None)])
    docs = docs.selectExpr("*", "doc_id AS pos", "1 AS rank", "2 AS hash", "'x' AS block", "0 AS digit", "'y' AS row")
    target = spark.createDataFrame([(1, "alpha beta")], SCHEMA)
    ranked = R.rank_documents(docs, target).where("rank IS NOT NULL")
    drawn = R.resample(docs, target)
    assert drawn.columns == docs.columns
    assert Counter(r.doc_id for r in drawn.collect()) == Counter(r.doc_id for r in ranked.collect())
    assert drawn.count() == sum(len(item_words(t)) >= 20 for t in [*texts, texts[0]]) * 25 // 100
