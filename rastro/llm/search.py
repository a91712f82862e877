"""Operator 12, ranked lexical search: term at a time, with a limited set of accumulators.

Documents are cut into the terms of the queries once and written as narrow rows: length, terms, counts. Corpus
statistics come from that table. A task then takes stretches of documents, turns them into posting lists, and answers every
query term at a time, the rarest term first. An accumulator is a document's partial score. As soon as the bounds of the
remaining terms (weight times the largest part of the term in the stretch) cannot reach the k-th partial score, or the k-th
score that the task has found already, no accumulators are created any more; those that exist are updated to
their exact scores. Each task sends its k best documents per query, which meet in two steps.

Queries are answered in blocks of bounded size, so the vocabulary and the queries that a task holds are bounded; each
block reads the documents once. Nothing about a document but its best scores leaves its task.

Defined results: a null or empty text has no terms, is not counted, and is never found. A query without terms, or whose
terms occur nowhere, has no results. Rows of documents are ranked one by one, so a repeated row is found twice. Repeated queries
(equal id and text) are one. A null id of a document comes last among equal scores. Empty tables give no results.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastro.llm.resampling import FOLD
from rastro.llm.workers import find_package
from rastro.session import scratch_path

RESULTS = 10
#: Bytes of query text in a block, about.
QUERY_BYTES = 4 << 20
#: Lists that meet at once in the first step of merging.
MERGED_LISTS = 256

POSTINGS = "doc_id bigint, n_terms bigint, terms array<int>, counts array<int>"
FOUND = "query int, doc_id bigint, score bigint"


def terms_of(data):
    """Terms of UTF-8 text: bytes of letters, digits and everything beyond ASCII, A to Z in lower case."""
    return data.translate(FOLD).split()


def _postings(shared):
    def run(batches):
        numbers = shared.value
        for batch in batches:
            ids, lengths, terms, counts, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_buffer().to_pybytes())
                if not words:
                    continue
                found = [(numbers[term], n) for term, n in Counter(words).items() if term in numbers]
                found.sort()
                ids.append(doc_id)
                lengths.append(len(words))
                terms += [term for term, _ in found]
                counts += [n for _, n in found]
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ],
                ["doc_id", "n_terms", "terms", "counts"],
            )

    return run


def term_weights(n_docs, frequencies):
    """Weight of each term in thousandths, from the number of documents that hold it."""
    return [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in frequencies]


def _inverted(batch, n_docs, n_terms, vocabulary):
    """Posting lists of a stretch: begin of each term's list, documents, and the part of the score without the weight."""
    lengths = batch.column(1).to_pylist()
    scales = np.array([8 * (25 + 75 * n * n_docs // n_terms) for n in lengths], np.int64)
    lists, counts = batch.column(2), batch.column(3)
    ends = lists.offsets.to_numpy().astype(np.int64)
    terms = lists.values.to_numpy()[ends[0] : ends[-1]]
    begin = counts.offsets.to_numpy()[0]
    tf = counts.values.to_numpy()[begin : begin + len(terms)].astype(np.int64)
    places = np.repeat(np.arange(len(lengths)), np.diff(ends))
    parts = 1_000_000_000 * tf // (1000 * tf + scales[places])
    order = np.argsort(terms, kind="stable")
    begins = np.searchsorted(terms[order], np.arange(vocabulary + 1))
    return begins, places[order], parts[order]


def _kth(scores, k):
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def accumulate(query, postings, bounds, n_rows, k, least):
    """Partial scores of a stretch's documents for one query; every document that can be among the k best is exact.

    ``query`` has (term, weight times occurrences), rarest first; ``least`` is a score that the k-th result has at least.
    """
    begins, docs, parts = postings
    known = [(t, w) for t, w in query if begins[t] < begins[t + 1] and w]
    remaining = np.cumsum([w * bounds[t] for t, w in known][::-1])[::-1]
    scores = np.zeros(n_rows, np.int64)
    creating = True
    for (term, weight), rest in zip(known, remaining.tolist()):
        if creating:
            # equal scores are told apart by id, so a bound that just reaches the k-th score still counts
            creating = least <= rest and (scores.max() <= rest or _kth(scores[scores > 0], k) <= rest)
        here = slice(begins[term], begins[term + 1])
        held, gained = docs[here], weight * parts[here]
        if not creating:
            held_already = scores[held] > 0
            held, gained = held[held_already], gained[held_already]
        scores[held] += gained  # a term lists a document once
    return scores


def _best(scores, missing, ids, k):
    """The k best of (score, id), ids upwards among equal scores, null last."""
    order = np.lexsort((ids, missing, -scores))[:k]
    return scores[order], missing[order], ids[order]


def _searcher(shared, n_docs, n_terms, k):
    def run(batches):
        queries, vocabulary = shared.value
        none = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        best = [none] * len(queries)
        for batch in batches:
            if not batch.num_rows:
                continue
            postings = _inverted(batch, n_docs, n_terms, vocabulary)
            begins, _, parts = postings
            bounds = np.zeros(vocabulary, np.int64)
            listed = np.flatnonzero(np.diff(begins))
            if len(listed):
                bounds[listed] = np.maximum.reduceat(parts, begins[listed])
            bounds = bounds.tolist()
            ids = batch.column(0)
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for number, query in enumerate(queries):
                old = best[number]
                least = int(old[0][k - 1]) if len(old[0]) == k else 0
                scores = accumulate(query, postings, bounds, len(ids), k, least)
                new = np.flatnonzero(scores >= max(least, 1))
                if len(new) > 4 * k:
                    new = new[scores[new] >= _kth(scores[new], k)]
                if len(new):
                    both = zip(old, (scores[new], missing[new], ids[new]))
                    best[number] = _best(*[np.concatenate(pair) for pair in both], k)
        sizes = [len(scores) for scores, _, _ in best]
        scores, missing, ids = (np.concatenate(x) for x in zip(*best)) if best else none
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(best)), sizes), pa.int32()),
                pa.array(ids, pa.int64(), mask=missing),
                pa.array(scores, pa.int64()),
            ],
            ["query", "doc_id", "score"],
        )

    return run


def _top(rows, k, *keys):
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block_results(docs, queries, k):
    """Results of a block of queries, rows with an id and a text: query (its place), rank, doc_id, score."""
    spark, context = docs.sparkSession, docs.sparkSession.sparkContext
    counted = [Counter(terms_of((query["text"] or "").encode())) for query in queries]
    numbers = {term: i for i, term in enumerate(sorted(set().union(*counted)))}
    folder = scratch_path(spark, "postings")
    docs.mapInArrow(_postings(context.broadcast(numbers)), POSTINGS).write.parquet(folder)
    postings = spark.read.schema(POSTINGS).parquet(folder)
    n_docs, n_terms = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    df = [0] * len(numbers)
    holding = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)))
    for term, n in holding.collect():  # no more rows than terms in the block
        df[term] = n
    weights = term_weights(n_docs, df)
    # rarest first
    plans = [
        sorted(((numbers[t], weights[numbers[t]] * n) for t, n in terms.items()), key=lambda x: (df[x[0]], x[0]))
        for terms in counted
    ]
    held = postings.where(F.size("terms") > 0)
    found = held.mapInArrow(_searcher(context.broadcast((plans, len(numbers))), n_docs, n_terms, k), FOUND)
    # a query's lists, k rows from each task, meet by groups first
    salted = found.withColumn("salt", F.floor(F.spark_partition_id() / MERGED_LISTS))
    return _top(_top(salted, k, "query", "salt").drop("rank"), k, "query").drop("salt")


def search(docs, queries, doc_id="doc_id", text="text", item_id="item_id", query_text="text", k=RESULTS,
           query_bytes=QUERY_BYTES):
    """The ``k`` best documents of each query with a score above 0: item_id, rank, doc_id, score.

    Reads the queries and makes the corpus statistics when called.
    """
    spark = docs.sparkSession
    find_package(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("data"))
    rows = rows.where(F.length("data") > 0)
    asked = queries.select(F.col(item_id).alias("item_id"), F.col(query_text).alias("text")).distinct()
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    n_blocks = int(size) // query_bytes + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    kind = asked.schema["item_id"].dataType
    names = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item_id", kind)])
    results = None
    for number in range(n_blocks):
        members = asked.where(block == number).collect()  # about query_bytes
        labels = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(members)], names)
        found = _block_results(rows, members, k).join(labels, "query")
        found = found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        results = found if results is None else results.unionByName(found)
    return results


#: The results in SQL.
REPORT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
q AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
s AS (SELECT count(*) AS n, CAST(sum(len(words)) AS BIGINT) AS l FROM d WHERE len(words) > 0),
qt AS (SELECT q, term, count(*) AS n FROM (SELECT q, unnest(words) AS term FROM q) GROUP BY ALL),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM d)
  WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
parts AS (
  SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(words) * n) // l))) AS part
  FROM tf JOIN d USING (r) JOIN w USING (term), s),
scores AS (
  SELECT q, r, CAST(sum(qt.n * part) AS BIGINT) AS score FROM qt JOIN parts USING (term) GROUP BY q, r),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id, r) AS INT) AS rank, doc_id, score
  FROM scores JOIN q USING (q) JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
