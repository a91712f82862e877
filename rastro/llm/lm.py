"""Operator 9, language-model scoring: stupid backoff over n-gram counts of the whole corpus.

A word's score is the share of its context's occurrences that it follows, at the longest order that was seen;
each shorter order costs a factor. A document is scored by the rest of the corpus: its own occurrences are
taken off every count, else each of its n-grams would be known.

The counting is a join by hash. Texts are dealt into parts. A part lists its distinct n-grams with
their counts, which is the aggregation before the shuffle: an n-gram that fills a third of the corpus is one
entry per part. The lists are cut by ranges of the hash; each range is summed over all parts
(the count table of that range) and joined back to the entries it came from. Every part then has the
corpus counts of its n-grams, and scores and sums per document. Orders above two are asked for after
the order below: an n-gram that occurs elsewhere has parts that do, so all others are known to be unseen.
Lists travel as compressed arrays, not as a row per n-gram, which is what keeps the shuffle small. Words and
n-grams are compared by 64-bit hashes.

Defined results: words are runs of anything but ASCII white space. Null, empty and blank texts have no
words and a null score. Rows are documents: repeated rows score each other. Null ids are kept. A corpus of one
document scores it as unseen throughout.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import functions as F

from rastro.llm.packing import TEXTS, columns_of, documents_of, pack, pack_texts, unpack
from rastro.llm.quality import words_of
from rastro.llm.workers import find_package

ORDER = 3
BACKOFF = 0.4
#: Bytes of text in a part.
PART_BYTES = 6 << 20


def _mixed(h):
    """A bijective mix of 64-bit values, so that sums of hashes spread."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ngrams(words, sizes, order):
    """For each order the hash of the n-gram that ends at each word, and where one does."""
    at = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    hashes, current = [], _mixed(words + np.uint64(1))
    for n in range(1, order + 1):
        if n > 1:
            before = np.concatenate([np.zeros(1, np.uint64), current[:-1]])
            current = _mixed(before * np.uint64(0x9E3779B97F4A7C15) + words + np.uint64(n))
        hashes.append((current, at >= n - 1))
    return hashes


def _words(data, offsets):
    """Hash of every word of the documents, and the number of words of each."""
    texts = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.values.dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    is_word = np.array([len(w) > 0 for w in words], bool)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    kept = is_word[codes]
    upto = np.concatenate([[0], np.cumsum(kept)])[lists.offsets.to_numpy()]
    return hashes[codes[kept]], np.diff(upto)


def stages_of(order):
    """Orders that are asked for together."""
    return [tuple(range(1, min(order, 2) + 1)), *((n,) for n in range(3, order + 1))]


class Part:
    """The n-grams of some documents, and in how many places outside its document each occurs."""

    def __init__(self, words, sizes, order):
        self.words, self.sizes = words, sizes
        self.rows = np.repeat(np.arange(len(sizes)), sizes)
        self.grams = ngrams(words, sizes, order)
        self.others = []

    def ask(self, orders):
        """Distinct n-grams of ``orders`` that may occur elsewhere, sorted, and their counts."""
        self.asked = []
        for n in orders:
            may = self.grams[n - 1][1]
            if n > 2:
                seen = self.others[n - 2] > 0
                may = may & seen & np.append(False, seen[:-1])
            self.asked.append(may)
        hashes = [self.grams[n - 1][0][may] for n, may in zip(orders, self.asked)]
        distinct, self.places, counts = np.unique(
            np.concatenate(hashes), return_inverse=True, return_counts=True
        )
        self.n_distinct = len(distinct)
        return distinct, counts

    def hear(self, corpus):
        """Take in the corpus counts of what was asked for."""
        corpus, begin = corpus.astype(np.int64), 0
        for may in self.asked:
            place = self.places[begin : begin + int(may.sum())]
            begin += len(place)
            _, inverse, own = np.unique(
                self.rows[may] * self.n_distinct + place, return_inverse=True, return_counts=True
            )
            rest = np.zeros(len(self.words), np.int64)
            rest[may] = corpus[place] - own[inverse]
            self.others.append(rest)

    def scores(self, total, backoff):
        """Logarithm of each word's stupid-backoff score."""
        left = (total - self.sizes)[self.rows]  # words of all other documents
        orders = reduce(np.add, [ends.astype(np.int64) for _, ends in self.grams])
        score = np.log(backoff) * orders - np.log(left + 1.0)  # never seen elsewhere
        for n, rest in enumerate(self.others, 1):
            seen = rest > 0
            context = left if n == 1 else np.append(0, self.others[n - 2][:-1])
            score[seen] = np.log(rest[seen] / context[seen]) + np.log(backoff) * (orders[seen] - n)
        return score


_ENTRIES = "hash_range bigint, part bigint, n bigint, hashes binary, counts binary"
_COUNTS = "part bigint, stage bigint, hash_range bigint, n bigint, counts binary"


def _part(texts, replies, order, stage):
    """A part's documents with the replies to the stages before ``stage``."""
    ids, data, offsets = documents_of(texts)
    part = Part(*_words(data, offsets), order)
    heard = sorted(replies, key=lambda r: (r["stage"], r["hash_range"]))
    for number, orders in enumerate(stages_of(order)[:stage]):
        part.ask(orders)
        counts = [unpack(r["counts"], r["n"], np.uint64) for r in heard if r["stage"] == number]
        part.hear(np.concatenate([np.empty(0, np.uint64), *counts]))
    return ids, part


def _entries(order, stage, bits):
    """A part's n-grams of a stage, by range of the hash."""

    def listed(texts, replies):
        _, part = _part(texts, replies, order, stage)
        distinct, counts = part.ask(stages_of(order)[stage])
        ranges = (distinct >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(distinct), np.int64)
        borders = np.searchsorted(ranges, np.arange((1 << bits) + 1))
        number = texts.column("part")[0].as_py()
        found = {"hash_range": [], "part": [], "n": [], "hashes": [], "counts": []}
        for r, (a, b) in enumerate(zip(borders, borders[1:])):
            if b > a:
                gaps = np.diff(distinct[a:b], prepend=np.uint64(0))
                for name, value in zip(found, (r, number, b - a, pack(gaps), pack(counts[a:b].astype(np.uint32)))):
                    found[name].append(value)
        return columns_of(_ENTRIES, found)

    def first(texts):
        return listed(texts, [])

    def later(texts, replies):
        return listed(texts, replies.to_pylist())

    return later if stage else first


def _summed(stage):
    """Corpus counts for the entries of one range, as asked for by each part."""

    def run(table):
        rows = table.to_pylist()
        hashes = np.concatenate([np.cumsum(unpack(r["hashes"], r["n"], np.uint64)) for r in rows])
        counts = np.concatenate([unpack(r["counts"], r["n"], np.uint32) for r in rows]).astype(np.float64)
        _, inverse = np.unique(hashes, return_inverse=True)
        totals = np.bincount(inverse, counts).astype(np.uint64)[inverse]
        ends = np.cumsum([r["n"] for r in rows])
        found = {"stage": [stage] * len(rows)} | {k: [r[k] for r in rows] for k in ("part", "hash_range", "n")}
        found["counts"] = [pack(totals[e - r["n"] : e]) for e, r in zip(ends, rows)]
        return columns_of(_COUNTS, found)

    return run


def _scorer(total, order, backoff, null_id):
    def run(texts, replies):
        ids, part = _part(texts, replies.to_pylist(), order, len(stages_of(order)))
        sizes = part.sizes
        sums = np.bincount(part.rows, part.scores(total, backoff), len(sizes))
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64(), mask=ids == null_id),
                "n_tokens": pa.array(sizes, pa.int64()),
                "score": pa.array(sums / np.maximum(sizes, 1), mask=sizes == 0),
            }
        )

    return run


def score_documents(docs, doc_id="doc_id", text="text", order=ORDER, backoff=BACKOFF):
    """One row per document: ``n_tokens`` and ``score``, the mean log score of its words.

    Counts the words of the corpus when called. The id 2^63 - 1 is taken for null.
    """
    spark = docs.sparkSession
    find_package(spark)
    null_id = int(np.iinfo(np.int64).max)
    whole = F.coalesce(F.col(text), F.lit(""))
    ids = F.coalesce(F.col(doc_id).cast("long"), F.lit(null_id))
    rows = docs.select(F.xxhash64(ids, whole).alias("row"), ids.alias("id"), whole.cast("binary").alias("data"))
    n_bytes, total = docs.agg(
        F.coalesce(F.sum(F.octet_length(whole)), F.lit(0)),
        F.coalesce(F.sum(F.size(words_of(whole)).cast("long")), F.lit(0)),
    ).first()
    n_parts = int(n_bytes) // PART_BYTES + 1
    # as many ranges as parts, so a range holds about as many entries as a part
    bits = (n_parts - 1).bit_length()
    # the shuffle by part is made once; every stage reads it
    texts = rows.mapInArrow(pack_texts(n_parts), TEXTS).groupBy("part")
    replies = None
    for stage in range(len(stages_of(order))):
        asked = texts if replies is None else texts.cogroup(replies.groupBy("part"))
        entries = asked.applyInArrow(_entries(order, stage, bits), _ENTRIES)
        counts = entries.groupBy("hash_range").applyInArrow(_summed(stage), _COUNTS)
        replies = counts if replies is None else replies.unionByName(counts)
    return texts.cogroup(replies.groupBy("part")).applyInArrow(
        _scorer(total, order, backoff, null_id), "doc_id bigint, n_tokens bigint, score double"
    )


def score_report(docs):
    """One row per document, its score rounded to six places."""
    scored = score_documents(docs)
    return scored.withColumn("score", F.round("score", 6))


#: The report in SQL.
REPORT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
t AS (SELECT r, i, len(w) AS n, w[greatest(i - 2, 1) : i] AS w
      FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
g AS (
  SELECT r, i, 1 AS k, w[-1:] AS g FROM t
  UNION ALL SELECT r, i, 2, w[-2:] FROM t WHERE i >= 2
  UNION ALL SELECT r, i, 3, w FROM t WHERE i >= 3),
c AS (
  SELECT r, i, k, count(*) OVER (PARTITION BY k, g) - count(*) OVER (PARTITION BY k, g, r) AS c FROM g),
total AS (SELECT count(*) AS n FROM t),
s AS (
  SELECT t.r, t.i, least(t.i, 3) AS k, (SELECT n FROM total) - t.n AS rest, a.c AS c1, b.c AS c2, e.c AS c3,
    p.c AS p1, q.c AS p2
  FROM t JOIN c a ON a.r = t.r AND a.i = t.i AND a.k = 1
  LEFT JOIN c b ON b.r = t.r AND b.i = t.i AND b.k = 2
  LEFT JOIN c e ON e.r = t.r AND e.i = t.i AND e.k = 3
  LEFT JOIN c p ON p.r = t.r AND p.i = t.i - 1 AND p.k = 1
  LEFT JOIN c q ON q.r = t.r AND q.i = t.i - 1 AND q.k = 2),
l AS (
  SELECT r, CASE WHEN c3 > 0 THEN ln(c3 / p2) WHEN c2 > 0 THEN ln(c2 / p1) + (k - 2) * ln(0.4::DOUBLE)
    WHEN c1 > 0 THEN ln(c1 / rest) + (k - 1) * ln(0.4::DOUBLE)
    ELSE k * ln(0.4::DOUBLE) - ln(rest + 1.0::DOUBLE) END AS s
  FROM s)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, round(x.score, 6) AS score
FROM d LEFT JOIN (SELECT r, avg(s) AS score FROM l GROUP BY r) x USING (r)
"""
