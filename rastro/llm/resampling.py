"""Operator 13, importance resampling towards a target: array-scored weights, ranks by a distributed radix sort.

Features are runs of one and two words, hashed into a fixed number of buckets. Two arrays of counts, of the documents
and of the target texts, give an array with the gain of each bucket; a document's weight is the floored mean
of the gains at its features, and its score is the weight plus Gumbel noise made from its id. The highest
scores are a draw without replacement.

Ranks come from a least-significant-digit radix sort over the composite key (score downwards, id upwards). Rows lie
in blocks by their position. A pass counts the digits of each block, sums the counts over (digit, block) to the first
destination of each, and every block deals its rows to their destinations in a stable counting sort. Every pass is
written to the shared folder, so a lost executor costs a task. Blocks, digits and count tables have fixed bounds;
digits that all rows share take no pass.

Defined results: a null or empty text has no words, no features and weight 0. Documents below ``min_words`` are scored but never
ranked. A null id has the noise of an empty id and comes last among equal scores. Rows with equal score and id keep
the order in which they were read. An empty target has gains too, from the smoothing; empty documents give an empty table.
"""

import hashlib
import math
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from rastro.llm.workers import find_package
from rastro.session import scratch_path

BUCKETS = 10_000
MIN_WORDS = 20
SEED = 7
#: Share of the documents with enough words that is drawn, in hundredths.
PERCENT = 25
DIGIT_BITS = 12
#: Rows of a block at most; smaller tables have blocks for every shuffle partition.
BLOCK_ROWS = 1 << 20
#: ASCII letters in lower case and digits stay, the rest of ASCII separates words; other bytes are letters.
FOLD = bytes(ord(chr(b).lower()) if b > 127 or chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))

SCORED = "doc_id bigint, hash bigint, n_words bigint, n_features bigint, weight bigint, score bigint"


def buckets_of(words, n_buckets):
    """Bucket of every word and of every two neighbours, which are hashed as joined by one space."""
    single = list(map(crc32, words))
    pairs = map(crc32, [b" " + word for word in words[1:]], single)
    hashes = np.fromiter(chain(single, pairs), np.uint32, max(2 * len(words) - 1, 0))
    return hashes % n_buckets


def _texts(column):
    return (value.as_buffer().to_pybytes() if value.is_valid else b"" for value in column)


def _counter(n_buckets):
    def run(batches):
        counts = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for data in _texts(batch.column(0)):
                counts += np.bincount(buckets_of(data.translate(FOLD).split(), n_buckets), minlength=n_buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["bucket", "n"])

    return run


def feature_counts(rows, text="text", n_buckets=BUCKETS):
    """Array with the number of features in each bucket, over all rows; its length is fixed."""
    find_package(rows.sparkSession)
    data = rows.select(F.col(text).cast("binary"))
    # a task sends a row per bucket at most
    partial = data.mapInArrow(_counter(n_buckets), "bucket bigint, n bigint")
    counts = np.zeros(n_buckets, np.int64)
    for bucket, n in partial.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def bucket_gains(corpus, target):
    """Gain of each bucket in thousandths: smoothed log share in the target over that in the corpus, floored."""
    size = len(corpus)
    all_s, all_t = int(corpus.sum()) + size, int(target.sum()) + size
    return np.array(
        [
            math.floor(1000 * math.log(float((t + 1) * all_s) / float((s + 1) * all_t)))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def _scorer(gains, seed):
    def run(batches):
        table = gains.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            sizes, features, weights, scores = [], [], [], []
            for doc_id, data in zip(ids, _texts(batch.column(2))):
                words = data.translate(FOLD).split()
                buckets = buckets_of(words, len(table))
                weight = int(table[buckets].sum()) // len(buckets) if len(buckets) else 0
                name = f"{seed}:{'' if doc_id is None else doc_id}"
                h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
                noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
                sizes.append(len(words))
                features.append(len(buckets))
                weights.append(weight)
                scores.append(weight + noise)
            made = [pa.array(x, pa.int64()) for x in (sizes, features, weights, scores)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *made],
                ["doc_id", "hash", "n_words", "n_features", "weight", "score"],
            )

    return run


def score_documents(docs, target, doc_id="doc_id", text="text", target_text="text", n_buckets=BUCKETS, seed=SEED):
    """Each document's words, features, weight and score; ``hash`` is that of its text. Counts all features when called."""
    spark = docs.sparkSession
    gains = bucket_gains(feature_counts(docs, text, n_buckets), feature_counts(target, target_text, n_buckets))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("hash"), F.col(text).cast("binary")
    )
    return rows.mapInArrow(_scorer(spark.sparkContext.broadcast(gains), seed), SCORED)


# --- radix sort ------------------------------------------------------------------------------


def _dealt(rows, offsets):
    """Rows of a block at their new positions: a stable counting sort by digit."""
    old = np.argsort(rows["pos"].to_numpy())
    digits = rows["digit"].to_numpy()[old].astype(np.uint16)
    order = np.argsort(digits, kind="stable")  # a radix sort for 16 bits
    digits = digits[order]
    known = np.argsort(offsets["digit"].to_numpy())
    values, base = offsets["digit"].to_numpy()[known], offsets["base"].to_numpy()[known]
    within = np.arange(len(digits)) - np.searchsorted(digits, digits, side="left")
    places = base[np.searchsorted(values, digits)] + within
    moved = rows.drop_columns(["pos", "digit", "block"]).take(pa.array(old[order]))
    return moved.append_column("pos", pa.array(places, pa.int64()))


def _destinations(counts):
    """First destination of the rows of each (digit, block): all rows of smaller digits, then those of earlier blocks."""
    before = F.coalesce(F.sum("n").over(Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # at most 2 ** DIGIT_BITS rows
    smaller = counts.groupBy("digit").agg(F.sum("n").alias("n")).select("digit", before.alias("smaller"))
    blocks = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(blocks), F.lit(0))
    return (
        counts.select("digit", "block", earlier.alias("earlier"))
        .join(smaller, "digit")
        .select("digit", "block", (F.col("smaller") + F.col("earlier")).alias("base"))
    )


def radix_sorted(rows, digits, n_rows, block_rows=BLOCK_ROWS):
    """``rows`` with ``pos``, from 0 in the order of ``digits``, columns that go from the least significant digit up.

    Each digit is a whole number below 2 ** DIGIT_BITS. ``rows`` must be a written table, because its order is the
    order of equal rows. Runs a job or two per digit when called.
    """
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = max(1, min(block_rows, -(-n_rows // partitions)))
    names = rows.columns
    rows = rows.withColumn("pos", F.monotonically_increasing_id())
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema)
    for number, digit in enumerate(digits or [F.lit(0)]):
        block = F.floor(F.col("pos") / size)
        if number == 0:
            # positions begin anew in every partition of the input
            block = F.shiftright("pos", 33) * (1 << 33) + F.floor(F.col("pos").bitwiseAND((1 << 33) - 1) / size)
        keyed = rows.select("*", digit.cast("int").alias("digit"), block.cast("long").alias("block"))
        counted = scratch_path(spark, "radix-counts")
        keyed.groupBy("digit", "block").agg(F.count(F.lit(1)).alias("n")).write.parquet(counted)
        counts = spark.read.parquet(counted)
        moved = (
            keyed.groupBy("block")
            .cogroup(_destinations(counts).groupBy("block"))
            .applyInArrow(_dealt, fields)
        )
        folder = scratch_path(spark, "radix")
        moved.write.parquet(folder)
        rows = spark.read.parquet(folder)
    return rows.select(*names, "pos")


def _digits(key, low, high):
    """Digits of an unsigned 64-bit key whose smallest and largest value are given; those that never differ are left out."""
    mask = (1 << DIGIT_BITS) - 1
    return [
        F.shiftrightunsigned(key, shift).bitwiseAND(mask) for shift in range(0, (low ^ high).bit_length(), DIGIT_BITS)
    ]


def rank_documents(docs, target, doc_id="doc_id", text="text", percent=PERCENT, min_words=MIN_WORDS, **options):
    """``score_documents`` with ``rank``, from 1, for the drawn share of the documents with enough words; null for the rest."""
    spark = docs.sparkSession
    find_package(spark)
    folder = scratch_path(spark, "scored")
    score_documents(docs, target, doc_id, text, **options).write.parquet(folder)
    scored = spark.read.schema(SCORED).parquet(folder)
    able = scored.where(F.col("n_words") >= min_words)
    n, low, high, first, last, nulls = able.agg(
        F.count(F.lit(1)), F.min("score"), F.max("score"), F.min("doc_id"), F.max("doc_id"),
        F.count_if(F.col("doc_id").isNull()),
    ).first()
    digits = []
    if first is not None:
        sign = 1 << 63
        unsigned = F.coalesce("doc_id", F.lit(0)).bitwiseXOR(F.lit(-sign))
        # a null id counts as 0 here, and is put last by a digit of its own
        span = [first, last, 0] if nulls else [first, last]
        digits += _digits(unsigned, min(span) + sign, max(span) + sign)
    if nulls:
        digits.append(F.col("doc_id").isNull())
    if n:
        digits += _digits(F.lit(high) - F.col("score"), 0, high - low)
    ranked = radix_sorted(able, digits, n)
    drawn = n * percent // 100
    rank = F.when(F.col("pos") < drawn, F.col("pos") + 1)
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", rank).drop("pos").unionByName(rest)


def resample(docs, target, doc_id="doc_id", text="text", **options):
    """The rows of ``docs`` that are drawn, whole. Rows with equal id and text are drawn together if one of them is."""
    ranked = rank_documents(docs, target, doc_id, text, **options)
    drawn = ranked.where(F.col("rank").isNotNull()).select(
        F.struct(F.col("doc_id").alias("id"), "hash").alias("drawn_key")
    )
    key = F.struct(F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("hash"))
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"))
    same = rows["key.hash"] == drawn["drawn_key.hash"]
    return rows.join(drawn, same & rows["key.id"].eqNullSafe(drawn["drawn_key.id"]), "left_semi").select("row.*")


def resampling_report(docs, target):
    """One row per document: features, weight, score, and its rank if it is drawn."""
    return rank_documents(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


#: The report in SQL; crc32 byte by byte over the distinct features.
REPORT_SQL = r"""
WITH RECURSIVE polynomial(v, c, k) AS (
  SELECT CAST(range AS BIGINT), CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL
  SELECT v, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM polynomial WHERE k < 8),
crc AS (SELECT list(c ORDER BY v) AS entries FROM polynomial WHERE k = 8),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
w AS (
  SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
f AS (
  SELECT side, r, unnest(list_concat(words,
    list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM w),
g AS (SELECT side, r, feature, count(*) AS n FROM f GROUP BY ALL),
h AS (SELECT feature, hex(encode(feature)) AS x FROM (SELECT DISTINCT feature FROM g)),
b AS (
  SELECT feature, xor(list_reduce(
    list_transform(range(len(x) // 2), lambda i: CAST('0x' || x[2 * i + 1 : 2 * i + 2] AS BIGINT)),
    lambda c, v: xor(c // 256, entries[xor(c % 256, v) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM h, crc),
c AS (
  SELECT bucket, CAST(sum(CASE WHEN side = 'd' THEN n ELSE 0 END) AS BIGINT) AS s,
    CAST(sum(CASE WHEN side = 'b' THEN n ELSE 0 END) AS BIGINT) AS t FROM g JOIN b USING (feature) GROUP BY bucket),
totals AS (SELECT CAST(sum(s) AS BIGINT) AS all_s, CAST(sum(t) AS BIGINT) AS all_t FROM c),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (all_s + 10000) AS DOUBLE)
    / CAST((s + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM c, totals),
means AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total
  FROM g JOIN b USING (feature) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT r, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
    CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS noise
  FROM w LEFT JOIN means USING (r) WHERE side = 'd'),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY weight + noise DESC, doc_id, r) AS place, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
