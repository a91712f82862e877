"""Operator 2, benchmark decontamination: a broadcast hash set of test n-grams, hits verified.

Benchmark texts are cut into windows of ten words (a shorter text is one window). The distinct windows,
by hash, are the table that training windows are looked up in. Every window of every training text
is hashed in the scan that reads it; only windows whose hash occurs are compared word by word, so the
result is exact. Only hits are shuffled.

The table of windows is broadcast if its measured size stays below ``broadcast_bytes``. Beyond that, hashes and places of
windows alone are shuffled, those that many texts share dealt over tasks, and the hits of a text meet its words once, to be
verified; so the work stays in proportion to the text.

Defined results: a null text has no words and is never contaminated. Benchmark items with null or empty text
have no window. Repeated rows of the same id and text give equal rows. Null ids are an id like any
other. An empty benchmark finds nothing.
"""

from pyspark.sql import functions as F

from rastro.operators.skew import salted_left_join
from rastro.session import scratch_path

WINDOW = 10
#: Everything in ASCII but letters and digits separates words; upper case is folded before.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text):
    """Column array of the normalised words; none for null."""
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(folded, SEPARATORS), "")


def _window_hash(words, first, length):
    return F.xxhash64(F.lit(length), *[F.get(words, first + k) for k in range(length)])


def _windows(rows, length, keep):
    """A row per window of exactly ``length`` words: ``keep``, its place and its hash."""
    words = F.col("words")
    places = F.sequence(F.lit(0), F.size(words) - length)
    return (
        rows.where(F.size(words) >= length)
        .select(*keep, "words", F.explode(places).alias("first"))
        .select(*keep, "words", "first", _window_hash(words, F.col("first"), length).alias("hash"))
    )


def benchmark_windows(benchmark, item_id="item_id", text="text"):
    """Distinct windows: hash, words, length, and the ids of the items that hold them, as strings."""
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("words")
    ).where(F.size("words") > 0)
    size = F.size("words")
    short = items.where(size < WINDOW).withColumn("first", F.lit(0)).withColumn("length", size)
    full = items.where(size >= WINDOW).select(
        "*",
        F.explode(F.sequence(F.lit(0), size - WINDOW)).alias("first"),
        F.lit(WINDOW).alias("length"),
    )
    window = F.slice("words", F.col("first") + 1, F.col("length"))
    return (
        short.unionByName(full)
        .select("item", "length", F.array_join(window, " ").alias("window"))
        .groupBy("length", "window")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def _known_windows(windows, length):
    """Hash, text and items of the benchmark's windows of one length."""
    parts = F.split("window", " ")
    of_length = windows.where(F.col("length") == length)
    return of_length.select(_window_hash(parts, F.lit(0), length).alias("hash"), "window", "items")


def _found_by_shuffle(rows, windows, lengths):
    """Windows of ``rows`` that occur in the benchmark: _key, first, length, items.

    A row of the shuffle has a window's hash and place, not the text it is from. Windows of all lengths are made in one pass.
    """
    words = F.col("words")

    def places_of(length):
        """First word and hash of every window of a length; none in shorter texts."""
        firsts = F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length))
        return F.transform(
            F.coalesce(firsts, F.array().cast("array<int>")),
            lambda i: F.struct(i.alias("first"), F.lit(length).alias("length"), _window_hash(words, i, length).alias("hash")),
        )

    texts = rows.dropDuplicates(["_key"])
    places = texts.select("_key", F.explode(F.concat(*map(places_of, lengths))).alias("at")).select("_key", "at.*")
    known = None
    for length in lengths:
        part = _known_windows(windows, length).withColumn("length", F.lit(length))
        known = part if known is None else known.unionByName(part)
    # windows whose hashes are equal are told apart by their text below
    listed = known.groupBy("hash", "length").agg(F.collect_list(F.struct("window", "items")).alias("known"))
    met = salted_left_join(places, listed, ["hash", "length"], ["_key", "first"]).where(F.col("known").isNotNull())
    # a text has no more hits than words
    hits = met.select("_key", "first", "length", F.explode("known").alias("known"))
    hits = hits.select("_key", F.struct("first", "length", "known").alias("hit"))
    hits = hits.groupBy("_key").agg(F.collect_list("hit").alias("hits"))

    def same(hit):
        return F.array_join(F.slice("words", hit["first"] + 1, hit["length"]), " ") == hit["known"]["window"]

    verified = hits.join(texts, "_key").select("_key", F.explode(F.filter("hits", same)).alias("hit"))
    return verified.select("_key", "hit.first", "hit.length", "hit.known.items")


def find_hits(docs, benchmark, text="text", broadcast_bytes=64 << 20):
    """Hits per ``_key``, a struct that names a row's id and text.

    They hold the key, the number of words inside windows and the items found; rows without a hit have none.
    Writes the windows of the benchmark, which is the small table, when called.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "benchmark-windows")
    benchmark_windows(benchmark).write.parquet(folder)
    windows = spark.read.parquet(folder)
    known = windows.groupBy("length").agg(
        F.sum(F.length("window") * 4 + F.size("items") * 24 + 80).alias("bytes")
    ).collect()  # one row per length, at most ten
    small = sum(r.bytes for r in known) <= broadcast_bytes
    rows = docs.select("_key", words_of(F.col(text)).alias("words"))
    lengths = sorted(r.length for r in known)
    if not lengths:
        return spark.createDataFrame([], "_key struct<id:string,hash:bigint>, n_hit int, items array<string>")
    hits = None
    for length in lengths if small else []:
        found = (
            _windows(rows, length, ["_key"])
            .join(F.broadcast(_known_windows(windows, length)), "hash")
            .where(F.array_join(F.slice("words", F.col("first") + 1, length), " ") == F.col("window"))
            .select("_key", "first", F.lit(length).alias("length"), "items")
        )
        hits = found if hits is None else hits.unionByName(found)
    if not small:
        hits = _found_by_shuffle(rows, windows, lengths)
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("first", "length"))),
        F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda state, w: F.struct(
            F.greatest(state["upto"], w["first"] + w["length"]).alias("upto"),
            (
                state["n"]
                + F.greatest(w["first"] + w["length"] - F.greatest(state["upto"], w["first"]), F.lit(0))
            ).alias("n"),
        ),
        lambda state: state["n"],
    )
    # a text's hits are no more than its words; a text is one row anyway
    return hits.groupBy("_key").agg(
        covered.alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def judge_contamination(docs, benchmark, doc_id="doc_id", text="text", broadcast_bytes=64 << 20):
    """One row per row of ``docs``: ``row``, all its columns, and ``n_words``, ``n_hit``, ``items``, ``contaminated``.

    Keeping the columns in a struct, names that occur on both sides do not clash.
    """
    key = F.struct(F.col(doc_id).cast("string").alias("id"), F.xxhash64(F.col(text)).alias("hash"))
    rows = docs.select(F.struct("*").alias("row"), key.alias("_key"), F.col(text).alias("_text"))
    hits = find_hits(rows, benchmark, "_text", broadcast_bytes).select(
        F.col("_key.id").alias("_id"), F.col("_key.hash").alias("_hash"), "n_hit", "items"
    )
    # the number of words is taken before the join, the text goes through it only if it is asked for
    counted = rows.select("row", "_key", F.size(words_of(F.col("_text"))).cast("long").alias("n_words"))
    same = counted["_key.id"].eqNullSafe(hits["_id"]) & (counted["_key.hash"] == hits["_hash"])
    return counted.join(hits, same, "left").select(
        "row",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def contamination_report(docs, benchmark, doc_id="doc_id", text="text"):
    """One row per document: words, words inside benchmark windows, items found, and the verdict."""
    judged = judge_contamination(docs.select(doc_id, text), benchmark, doc_id, text)
    return judged.select(
        F.col("row")[doc_id].alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


#: The report in SQL.
REPORT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
w AS (
  SELECT DISTINCT item, least(len(words), 10) AS n, words[i + 1 : i + 10] AS gram
  FROM (SELECT item, words, unnest(range(greatest(len(words) - 9, 1))) AS i FROM b WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT n FROM w),
g AS (
  SELECT r, i, n, words[i + 1 : i + n] AS gram
  FROM (SELECT r, words, n, unnest(range(len(words) - n + 1)) AS i
        FROM d, lengths WHERE len(words) >= n)),
hits AS (SELECT g.r, g.i, g.n, w.item FROM g JOIN w ON g.n = w.n AND g.gram = w.gram),
places AS (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)),
covered AS (SELECT r, count(*) AS n_hit FROM places GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""
