"""Source mixing: targets by repeated resharing, what the blocks hold, permutations, odd rows."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastro.llm import mixing as M

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)


def words(text):
    return re.findall(M.WORD, text or "")


def targets(sizes):
    """Deal the share by weight, again and again, as the task words it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    got, open_sources, left = dict.fromkeys(sizes, 0.0), set(sizes), 1.5 * sum(sizes.values())
    while open_sources and left > 1e-9:
        unit = left / sum(weight[s] for s in open_sources)
        left = 0.0
        for s in list(open_sources):
            got[s] += weight[s] * unit
            if got[s] > 2 * sizes[s]:
                left += got[s] - 2 * sizes[s]
                got[s] = 2 * sizes[s]
                open_sources.discard(s)
    return got


def some_rows(seed=1):
    rng = random.Random(seed)
    names = ["a", "b", "c", "é", None, "\U0001f600", "z", ""]
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else rng.choice(names)
        rows.append((i, " ".join(f"{i}.{j}" for j in range(rng.choice([1, 5, 60, 200]))), source))
    rows += [(900, None, "a"), (901, "", "b"), (902, " \n\t", None), (None, "x y z", "c"), (903, "only one", "tiny"), (904, "", "empty")]
    rows += [(905, "w " * 30_000, "long")] + [(906, "copy of mine", "copies")] * 50 + [(906, "other text", "copies")]
    return rows


@pytest.fixture(scope="module")
def mixed(spark):
    docs = spark.createDataFrame(some_rows(), SCHEMA).repartition(4)
    return docs, *M.plan_mix(docs, shard_slots=64, block_words=32)


def test_every_source_reaches_its_target(spark, mixed):
    docs, placed, slots = mixed
    by_id = {r[0]: r[2] for r in some_rows()}
    taken = M.words_taken(placed, slots, 32).collect()
    assert Counter(r.doc_id for r in taken) == Counter(r[0] for r in some_rows())
    sizes, got = Counter(), Counter()
    for _, text, source in some_rows():
        sizes[source] += len(words(text))
    wanted = targets({s: sizes[s] for s in {r[2] for r in some_rows()}})
    for r in taken:
        source = by_id[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(wanted[source])
        assert 0 <= r.taken <= 2 * r["size"]
        got[source] += r.taken
    assert {s: got[s] for s in wanted} == {s: int(t + 1e-6) for s, t in wanted.items()}
    assert sum(wanted.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_blocks_hold_the_words_that_are_counted(mixed):
    docs, placed, slots = mixed
    blocks = M.mixed_blocks(docs, placed, slots, block_words=32).collect()
    known = Counter()
    for row in M.words_taken(placed, slots, 32).where("doc_id < 400").collect():
        known[row.doc_id] += row.taken
    seen = Counter(int(w.split(".")[0]) for b in blocks for w in b.tokens if re.fullmatch(r"\d+\.\d+", w))
    assert seen == +known
    per_word = Counter(w for b in blocks for w in b.tokens if re.fullmatch(r"\d+\.\d+", w))
    assert max(per_word.values()) <= 2
    # blocks have the fixed length but for the last of a source and the slot that ends at the target
    short = Counter(b.number for b in blocks if len(b.tokens) < 32)
    assert max(len(b.tokens) for b in blocks) == 32 and max(short.values()) <= 3
    # no gaps, no slot twice
    numbers = defaultdict(list)
    for b in blocks:
        numbers[b.number].append(b.j)
    assert all(sorted(j) == list(range(len(j))) for j in numbers.values())


def test_counts_of_shards_are_multinomial(spark, mixed):
    """Each shard's counts are near its share of the slots; sources are not lined up one after another."""
    _, _, slots = mixed
    rows = slots.groupBy("shard", "number").count().collect()
    total = Counter()
    for r in rows:
        total[r.number] += r["count"]
    all_slots = total.total()
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r["count"]
    assert max(sizes.values()) == 64 and sum(n == 64 for n in sizes.values()) >= len(sizes) - 1
    number, n = total.most_common(1)[0]
    p = n / all_slots
    z = [(r["count"] - 64 * p) / (64 * p * (1 - p)) ** 0.5 for r in rows if r.number == number and sizes[r.shard] == 64]
    assert sum(x * x for x in z) / len(z) == pytest.approx(1, abs=0.6) and max(map(abs, z)) < 5


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.createDataFrame(some_rows(2), SCHEMA)

    def taken(rows):
        return Counter(map(tuple, M.mixing_report(rows).collect()))

    first = taken(docs.repartition(3))
    assert first == taken(docs.repartition(7)) == taken(docs.orderBy(F.desc("text")))


@pytest.mark.parametrize("size", [1, 2, 3, 64, 1000])
def test_permutations(spark, size):
    found = spark.range(size).select(M.permuted(F.col("id"), F.lit(size), F.lit(5)).alias("to")).collect()
    order = [r.to for r in found]
    assert sorted(order) == list(range(size))
    if size == 1000:
        assert abs(sum(abs(a - i) for i, a in enumerate(order)) / size - size / 3) < 25


def test_nothing_to_mix(spark):
    assert M.mixing_report(spark.createDataFrame([], SCHEMA)).count() == 0
    empty = spark.createDataFrame([(1, None, None), (2, "", "a")], SCHEMA)
    rows = sorted(map(tuple, M.mixing_report(empty).collect()))
    assert rows == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    (row,) = M.mixing_report(spark.createDataFrame([(1, "a b c d", None)], SCHEMA)).collect()
    assert tuple(row) == (1, 4, 4, 6.0, 6)


def test_other_columns_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x"), (2, "e f", "y")], SCHEMA)
    more = docs.selectExpr("*", "1 AS size", "'n' AS name", "2 AS row", "3 AS hash", "4 AS target", "5 AS number", "6 AS part")
    assert sorted(map(tuple, M.mixing_report(more).collect())) == sorted(map(tuple, M.mixing_report(docs).collect()))
    assert M.mixed_blocks(more, *M.plan_mix(more)).count() == M.mixed_blocks(docs, *M.plan_mix(docs)).count() > 0
