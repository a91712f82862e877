"""Operator 7, SimHash near-duplicates, found by multi-index hashing.

A text's fingerprint has a bit for each of 64 places: 1 if more than half of its shingles' hashes have it.
Two fingerprints that differ in at most 4 of 64 bits differ in at most 2 of the upper 34 bits or in at
most 1 of the lower 30. So an index per segment finds them: for the upper segment every fingerprint is
listed under all values within distance 1 of its own, and two that are within distance 2 meet at one
of them; for the lower, they meet where the ball of one holds the value of the other. That is 66 entries per
distinct fingerprint, whatever the corpus size, and with 2^34 and 2^30 values chance meetings stay
few. Complete distances are checked.

Copies have equal fingerprints and are one entry. Groups of near copies meet in the same buckets many
times over; all their pairs are never made. First each fingerprint of a bucket is compared with the bucket's
least one. Then only buckets that still hold several components are looked at again, and only pairs from
different components are made there: a pair inside a component could not change the result.

Defined results: null and empty texts, and texts of white space, have no words and fingerprint zero.
Rows are independent; repeated rows get the same values. Null ids do not take part in the smallest id of
a component, so a component of null ids alone has a null id.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from rastro.llm.components import connected_components
from rastro.llm.decontamination import LOWER, UPPER
from rastro.llm.quality import words_of
from rastro.llm.workers import find_package
from rastro.session import scratch_path

SHINGLE = 4
RADIUS = 4
#: Bits of the lower segment; the upper has the rest.
LOW_BITS = 30
HIGH_BITS = 64 - LOW_BITS
#: Hashes whose bits are spread out at once.
BLOCK = 1 << 18


def shingle_hashes(text, shingle=SHINGLE):
    """Column array of XXH64 (seed 42) of the shingles; a shorter text is one shingle."""
    words = words_of(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER))

    def hashes(words):
        places = F.sequence(F.lit(0), F.greatest(F.size(words) - shingle, F.lit(0)))
        full = F.transform(
            places,
            lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(words, i + k) for k in range(shingle)])),
        )
        return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(full)

    # a list of one, so that the text is split once
    return F.get(F.transform(F.array(words), hashes), F.lit(0))


def _majorities(hashes, offsets):
    """Fingerprint of each list: bits that more than half of its hashes have."""
    found = np.zeros(len(offsets) - 1, np.uint64)
    sizes = np.diff(offsets)
    counts = np.zeros((len(sizes), 64), np.int64)
    # lists are cut at block borders, so that a long one needs no more memory than a short one
    for start in range(int(offsets[0]), int(offsets[-1]), BLOCK):
        stop = min(start + BLOCK, int(offsets[-1]))
        bits = np.unpackbits(hashes[start:stop].view(np.uint8), bitorder="little").reshape(-1, 64)
        first = np.searchsorted(offsets, start, side="right") - 1
        last = np.searchsorted(offsets, stop, side="left")
        rows = np.arange(first, last)
        rows = rows[sizes[rows] > 0]
        begins = np.maximum(offsets[rows], start) - start
        counts[rows] += np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
    ones = 2 * counts > sizes[:, None]
    found = np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()
    return found.view(np.int64)


def _fingerprint_batches(batches):
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.to_numpy(zero_copy_only=False)
        prints = pa.array(_majorities(np.ascontiguousarray(values), offsets))
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, prints], [*batch.schema.names[:-1], "_print"])


def with_fingerprints(docs, text="text", shingle=SHINGLE, drop_text=True):
    """``docs`` with ``_print``, the fingerprint as a signed long."""
    find_package(docs.sparkSession)
    hashed = docs.withColumn("_hashes", shingle_hashes(F.col(text), shingle))
    if drop_text:
        hashed = hashed.drop(text)
    schema = hashed.drop("_hashes").withColumn("_print", F.lit(0).cast("long")).schema
    return hashed.mapInArrow(_fingerprint_batches, schema)


def _index(prints):
    """Entries (bucket, print, own): ``own`` marks the bucket of the fingerprint's own value."""
    high = F.shiftrightunsigned("_print", LOW_BITS)
    low = F.col("_print").bitwiseAND((1 << LOW_BITS) - 1)

    def ball(value, bits, tag):
        flips = [F.struct((value.bitwiseXOR(F.lit(1 << b)) + tag).alias("bucket"), F.lit(False).alias("own")) for b in range(bits)]
        return [F.struct((value + tag).alias("bucket"), F.lit(True).alias("own")), *flips]

    entries = F.array(*ball(high, HIGH_BITS, F.lit(0)), *ball(low, LOW_BITS, F.lit(1 << 40)))
    return prints.select("_print", F.explode(entries).alias("e")).select("_print", "e.bucket", "e.own")


def _distance(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def link_fingerprints(prints, radius=RADIUS):
    """Edges (a, b) between the distinct ``_print`` values that connect all that lie within ``radius``.

    Not every close pair is an edge, but any two are joined by a path of close pairs.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"radius must be 0 to {RADIUS}")
    spark = prints.sparkSession
    # a meeting in the lower segment needs the own value of one side; so buckets without one go
    bucket = Window.partitionBy("bucket")
    met = (
        _index(prints)
        .withColumns(
            {
                "least": F.min("_print").over(bucket),
                "greatest": F.max("_print").over(bucket),
                "owned": F.max("own").over(bucket),
            }
        )
        .where((F.col("least") < F.col("greatest")) & (F.col("owned") | (F.col("bucket") < 1 << 40)))
        .drop("owned", "own", "greatest")
    )
    folder = scratch_path(spark, "buckets")
    met.write.parquet(folder)
    met = spark.read.parquet(folder)
    stars = (
        met.where((F.col("least") < F.col("_print")) & (_distance("least", "_print") <= radius))
        .select(F.col("least").alias("a"), F.col("_print").alias("b"))
        .distinct()
    )
    folder = scratch_path(spark, "stars")
    stars.write.parquet(folder)
    stars = spark.read.parquet(folder)
    labels = connected_components(stars).withColumnRenamed("node", "_print")
    labelled = met.select("bucket", "_print").join(labels, "_print", "left").select(
        "bucket", "_print", F.coalesce("label", "_print").alias("label")
    )
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    rest = labelled.join(mixed.where("x < y").select("bucket"), "bucket")
    folder = scratch_path(spark, "mixed")
    rest.write.parquet(folder)
    rest = spark.read.parquet(folder)
    left = rest.select("bucket", F.col("_print").alias("a"), F.col("label").alias("la"))
    right = rest.select("bucket", F.col("_print").alias("b"), F.col("label").alias("lb"))
    more = (
        left.join(right, "bucket")
        .where((F.col("la") < F.col("lb")) & (_distance("a", "b") <= radius))
        .select("a", "b")
        .distinct()
    )
    return stars.unionByName(more)


def print_components(prints, doc_id="doc_id", radius=RADIUS):
    """Table (_print, label, component_id) of the fingerprints in ``prints`` (``doc_id``, _print).

    ``label`` is the least fingerprint of the component, ``component_id`` its least id.
    """
    spark = prints.sparkSession
    folder = scratch_path(spark, "prints")
    prints.groupBy("_print").agg(F.min(doc_id).alias("first")).write.parquet(folder)
    distinct = spark.read.parquet(folder)
    labels = connected_components(link_fingerprints(distinct.select("_print"), radius))
    labelled = distinct.join(labels.withColumnRenamed("node", "_print"), "_print", "left").select(
        "_print", "first", F.coalesce("label", "_print").alias("label")
    )
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    return labelled.join(least, "label").select("_print", "label", "component_id")


def near_duplicate_report(docs, doc_id="doc_id", text="text", radius=RADIUS):
    """One row per document: its fingerprint in hexadecimal and the smallest id it is linked to."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "fingerprints")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    with_fingerprints(rows).write.parquet(folder)
    prints = spark.read.parquet(folder)
    components = print_components(prints, radius=radius)
    return prints.join(components, "_print").select(
        "doc_id", F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs, doc_id="doc_id", text="text", radius=RADIUS):
    """One row of each group of near-duplicates: the one with the smallest id, null ids last.

    Of equal ids one row stays. The rows are written to the shared folder, with their fingerprints, when called.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "fingerprinted")
    marked = docs.select(
        F.struct("*").alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("_at"),
        F.col(text).alias("text"),
    )
    with_fingerprints(marked).write.parquet(folder)
    stored = spark.read.parquet(folder)  # row numbers are fixed from here on
    rows = stored.select("doc_id", "_at", "_print")
    components = print_components(rows, radius=radius)
    # first per fingerprint, then per group: copies meet in partial aggregation
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_at")).alias("first")
    kept = (
        rows.groupBy("_print")
        .agg(first)
        .join(components, "_print")
        .groupBy("label")
        .agg(F.min("first").alias("first"))
        .select("first._at")
    )
    return stored.join(kept, "_at", "left_semi").select("row.*")
