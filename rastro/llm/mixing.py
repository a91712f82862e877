"""Operator 11, mixing sources to target weights: blocks of fixed length, multinomial shards, blocks joined by index.

Words of a source, its documents in a pseudorandom order, form one stream that is cut into blocks of fixed length; the last block
of a source may be shorter. The mix has as many slots as the targets need, in shards of fixed size. Every shard draws
multinomial counts of sources: a slot draws one of all slots with replacement and takes the source it belongs to. The draws of a
source are numbered over all shards, in a pseudorandom order of shards. Draws beyond a source's slots are given to the
sources that lack some, so totals are exact. Slot number j of a source reads block j mod n of epoch j div n, through a
pseudorandom permutation of the full blocks in each epoch (swap-or-not rounds), and
slots and blocks meet in a join by (source, block). The last slot of a source is cut where its target is reached.

Targets: sources in the order of their names' code points, null last, weigh 5, 2, 1 and so on; the share is dealt by weight, and
targets above twice the source's size stop there, the excess dealt again, which sorts sources by size over weight.

A source may hold most rows: its documents are spread over chunks by a hash, as many as the square root of all documents, and sums run
within chunks, then over chunks. All sums over sources run within ranges, then over ranges. Draws depend on ids and texts only,
so reruns agree.

Defined results: a null text has size 0; documents of size 0 are never taken. Repeated rows are documents of their own; rows equal
in id and text share the same order key and are interchangeable. Null ids are an id like any other. Without words
all targets are 0. A whole epoch takes a document once; no document exceeds ``MOST`` times its size.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from rastro.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Share of all words that the mix takes, in hundredths, and how often a source may be taken at most.
PERCENT = 150
MOST = 2
BLOCK_WORDS = 128
SHARD_SLOTS = 4096
#: Tables of one row per source are broadcast up to this number of sources.
FEW_SOURCES = 10_000
ROUNDS = 24
SEED = 11

_BEFORE = (Window.unboundedPreceding, -1)


def _written(rows, label):
    folder = scratch_path(rows.sparkSession, label)
    rows.write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def _in_ranges(rows, *order):
    """``rows`` written with ``part``, the number of the range of ``order`` that they lie in."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _written(rows.repartitionByRange(partitions, *order).withColumn("part", F.spark_partition_id()), "ranges")


def _sums_before(rows, order, **sums):
    """New columns with the sums of columns over all rows before, in an order whose ranges are ``part``."""
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(*_BEFORE)
    earlier = Window.orderBy("part").rowsBetween(*_BEFORE)  # as many rows as ranges
    totals = rows.groupBy("part").agg(*[F.sum(column).alias(f"_{name}") for name, column in sums.items()])
    bases = totals.select("part", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums])
    own = rows.select("*", *[F.coalesce(F.sum(column).over(within), F.lit(0)).alias(n) for n, column in sums.items()])
    joined = own.join(bases, "part")
    return joined.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop(*[f"_{n}" for n in sums])


def _power_of_two(n):
    """The power of two next to the square root of ``n``."""
    return 1 << (max(int(n), 1).bit_length() // 2)


def source_targets(sizes, weights=WEIGHTS, percent=PERCENT, most=MOST):
    """``sizes`` (source, size; one row per source) with its ``number``, its weight and ``target``, a written table."""
    named = _in_ranges(sizes, F.asc_nulls_last("source"))
    numbered = _sums_before(named, [F.asc_nulls_last("source")], number=F.lit(1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("number", F.lit(len(weights))) + 1).cast("int"))
    sources = numbered.withColumn("weight", weight).withColumn("most", F.col("size") * most).drop("part")
    order = [F.col("most") / F.col("weight"), F.col("number")]
    ranged = _in_ranges(sources, *order)
    total, weighed = ranged.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    share = total * percent / 100
    filled = _sums_before(ranged, order, spent=F.col("most"), passed=F.col("weight"))
    # what a unit of weight gets if all sources before stop; a source stops if that is above its most
    unit = (share - F.col("spent")) / (weighed - F.col("passed"))
    filled = filled.withColumn("stops", F.col("most") < F.col("weight") * unit)
    spent, passed = filled.agg(
        F.coalesce(F.sum(F.when(F.col("stops"), F.col("most"))), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("stops"), F.col("weight"))), F.lit(0)),
    ).first()
    rest = (share - spent) / max(weighed - passed, 1)
    target = F.when(F.col("stops"), F.col("most").cast("double")).otherwise(F.col("weight") * F.lit(float(rest)))
    return _written(filled.select("number", "source", "weight", "size", target.alias("target")), "targets")


def _with_slots(targets, block_words, most):
    """Per source: words wanted, full blocks, all blocks and slots, and the slots of the sources before."""
    want = F.least(F.floor("target"), F.col("size") * most)
    sources = targets.withColumn("want", want.cast("long"))
    epochs = F.floor(F.col("want") / F.greatest("size", F.lit(1)))
    sources = sources.withColumns(
        {
            "full": F.floor(F.col("size") / block_words),
            "blocks": F.ceil(F.col("size") / block_words),
            "slots": epochs * F.ceil(F.col("size") / block_words)
            + F.ceil((F.col("want") - epochs * F.col("size")) / block_words),
        }
    )
    sources = _sums_before(_in_ranges(sources, "number"), ["number"], slots_before=F.col("slots"))
    return _written(sources, "sources")


def _found_in(rows, at, ranges, begin, size, n_ranges, n_all):
    """``rows`` joined with the one of ``ranges`` that holds the place ``at``, by segments of equal width."""
    width = max(1, n_all // (4 * max(n_ranges, 1)))
    first, last = F.floor(ranges[begin] / width), F.floor((ranges[begin] + ranges[size] - 1) / width)
    pieces = ranges.where(F.col(size) > 0).withColumn("segment", F.explode(F.sequence(first, last)))
    held = (F.col(at) >= F.col(begin)) & (F.col(at) < F.col(begin) + F.col(size))
    return rows.withColumn("segment", F.floor(F.col(at) / width)).join(pieces, "segment").where(held).drop("segment")


def draw_slots(spark, sources, shard_slots=SHARD_SLOTS, seed=SEED):
    """One row per slot of the mix: shard, number of the source, and ``j``, from 0 for each source without gaps."""
    n_sources, n_slots = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("slots"), F.lit(0))).first()
    parallel = max(spark.sparkContext.defaultParallelism, n_slots // (1 << 22) + 1)
    ticket = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(n_slots, 1)))
    slots = spark.range(0, n_slots, 1, parallel).select(
        F.floor(F.col("id") / shard_slots).alias("shard"), ticket.alias("ticket")
    )
    held = sources.select("number", "slots_before", "slots")
    drawn = _found_in(slots, "ticket", held, "slots_before", "slots", n_sources, n_slots)
    counts = _written(drawn.groupBy("shard", "number").agg(F.count(F.lit(1)).alias("n")), "counts")
    # number the draws of each source: within chunks of its shards, then over chunks
    mark = F.xxhash64(F.lit(seed), "number", "shard")
    chunk = F.pmod(mark, F.lit(_power_of_two(n_slots // shard_slots + 1)))
    marked = counts.withColumn("mark", mark).withColumn("chunk", chunk)
    chunks = marked.groupBy("number", "chunk").agg(F.sum("n").alias("n"))
    over = Window.partitionBy("number").orderBy("chunk").rowsBetween(*_BEFORE)
    within = Window.partitionBy("number", "chunk").orderBy("mark", "shard").rowsBetween(*_BEFORE)
    bases = chunks.select("number", "chunk", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    numbered = marked.withColumn("own", F.coalesce(F.sum("n").over(within), F.lit(0))).join(bases, ["number", "chunk"])
    numbered = numbered.select("shard", "number", "n", (F.col("base") + F.col("own")).alias("first"))
    # what a source drew beyond its slots, and what it lacks, in the order of sources
    totals = sources.select("part", "number", "slots").join(
        counts.groupBy("number").agg(F.sum("n").alias("drawn")), "number", "left"
    )
    totals = totals.withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    beyond, lacking = F.col("drawn") - F.col("slots"), F.col("slots") - F.col("drawn")
    totals = totals.withColumn("beyond", F.greatest(beyond, F.lit(0)))
    totals = totals.withColumn("lacking", F.greatest(lacking, F.lit(0)))
    totals = _written(
        _sums_before(totals, ["number"], beyond_before=F.col("beyond"), lacking_before=F.col("lacking")), "totals"
    )
    n_beyond = totals.agg(F.coalesce(F.sum("beyond"), F.lit(0))).first()[0]
    # a count stands for up to a shard of slots, so few bytes here are many rows after the next step
    numbered = numbered.repartition(parallel, "shard", "number")
    numbered = numbered.join(F.broadcast(totals) if n_sources <= FEW_SOURCES else totals, "number")
    end, own_end = F.col("first") + F.col("n"), F.least(F.col("first") + F.col("n"), "slots")
    kept = numbered.where(F.col("first") < F.col("slots")).select(
        "shard", "number", F.explode(F.sequence(F.col("first"), own_end - 1)).alias("j")
    )
    over_first = F.greatest("first", "slots")
    place = F.sequence(F.col("beyond_before") + over_first - F.col("slots"), F.col("beyond_before") + end - F.col("slots") - 1)
    spare = numbered.where(end > F.col("slots")).select("shard", F.explode(place).alias("place"))
    takers = totals.select("number", "drawn", "lacking_before", "lacking")
    given = _found_in(spare, "place", takers, "lacking_before", "lacking", n_sources, n_beyond)
    given = given.select("shard", "number", (F.col("drawn") + F.col("place") - F.col("lacking_before")).alias("j"))
    return kept.unionByName(given)


def permuted(index, size, key, rounds=ROUNDS):
    """A pseudorandom permutation of the numbers below ``size``, one for each ``key``.

    Each round pairs numbers that add up to a constant, and swaps a pair or not by a hash of its larger one.
    """
    size = F.greatest(size, F.lit(1))

    def swap_or_not(x, number):
        partner = F.pmod(F.pmod(F.xxhash64(key, number), size) + size - x, size)
        return F.when(F.xxhash64(key, number, F.greatest(x, partner)) % 2 == 0, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), index, swap_or_not)


def _sized(docs, doc_id, text, source, seed):
    """Documents as narrow rows, with a row number that holds for this table and the place in the order as a hash."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )


def plan_mix(docs, doc_id="doc_id", text="text", source="source", block_words=BLOCK_WORDS, shard_slots=SHARD_SLOTS,
             weights=WEIGHTS, percent=PERCENT, most=MOST, seed=SEED):
    """(documents, slots): where each document lies in its source's stream, and which block each slot of the mix reads.

    Documents: row, doc_id, hash, number and size of the source, target, size, and ``first``, the place of its first word. Slots:
    shard, number, ``j``, block, and ``words``, how many words of the block are taken. Both are written tables.
    """
    spark = docs.sparkSession
    sized = _written(_sized(docs, doc_id, text, source, seed), "sized")
    n_docs = sized.count()
    # a key that is never null, so joins and windows by it share their partitions
    name = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
    keyed = sized.withColumn("name", name).withColumn("chunk", F.pmod("hash", F.lit(_power_of_two(n_docs))))
    chunks = _written(keyed.groupBy("name", "chunk", "source").agg(F.sum("size").alias("size")), "chunks")
    targets = source_targets(chunks.groupBy("source").agg(F.sum("size").alias("size")), weights, percent, most)
    sources = _with_slots(targets, block_words, most)
    over = Window.partitionBy("name").orderBy("chunk").rowsBetween(*_BEFORE)
    bases = chunks.select("name", "chunk", F.coalesce(F.sum("size").over(over), F.lit(0)).alias("base"))
    known = sources.select(name.alias("name"), "number", F.col("size").alias("source_size"), "target")
    within = Window.partitionBy("name", "chunk").orderBy("hash", "doc_id", "row").rowsBetween(*_BEFORE)
    placed = keyed.withColumn("own", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(bases.join(known, "name"), ["name", "chunk"]).select(
        "row", "doc_id", "hash", "number", "source_size", "target", "size", (F.col("base") + F.col("own")).alias("first")
    )
    slots = draw_slots(spark, sources, shard_slots, seed)
    slots = slots.join(sources.select("number", "size", "want", "full", "blocks"), "number")
    epoch, index = F.floor(F.col("j") / F.col("blocks")), F.pmod("j", "blocks")
    slots = slots.withColumn("epoch", epoch).withColumn("index", index)
    key = F.xxhash64(F.lit(seed), "number", "epoch")
    slots = slots.withColumn("key", key)
    block = F.when(F.col("index") < F.col("full"), permuted(F.col("index"), F.col("full"), F.col("key")))
    start = F.col("index") * block_words
    left = F.col("want") - F.col("epoch") * F.col("size") - start
    slots = slots.select(
        "shard",
        "number",
        "j",
        block.otherwise(F.col("index")).alias("block"),
        F.least(F.lit(block_words), F.col("size") - start, left).alias("words"),
    )
    return _written(placed, "placed"), _written(slots, "slots")


def _pieces(placed, block_words, *more):
    """Parts of documents in blocks: number, block, ``place`` in the block, ``skip`` words of the document, ``n`` words."""
    first, end = F.col("first"), F.col("first") + F.col("size")
    blocks = F.sequence(F.floor(first / block_words), F.floor((end - 1) / block_words))
    begin = F.greatest(F.col("block") * block_words, first)
    stop = F.least((F.col("block") + 1) * block_words, end)
    return (
        placed.where(F.col("size") > 0)
        .select("number", "first", "size", *more, F.explode(blocks).alias("block"))
        .select(
            "number",
            "block",
            *more,
            (begin - F.col("block") * block_words).cast("int").alias("place"),
            (begin - first).alias("skip"),
            (stop - begin).cast("int").alias("n"),
        )
    )


def words_taken(placed, slots, block_words=BLOCK_WORDS):
    """``placed`` with ``taken``, the words of the document that the mix takes, repeats counted."""
    pieces = _pieces(placed, block_words, "row")
    taken = F.greatest(F.least(F.col("n"), F.col("words") - F.col("place")), F.lit(0)).cast("long")
    met = pieces.join(slots.select("number", "block", "words"), ["number", "block"])
    sums = met.groupBy("row").agg(F.sum(taken).alias("taken"))
    return placed.join(sums, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))


def mixed_blocks(docs, placed, slots, doc_id="doc_id", text="text", block_words=BLOCK_WORDS, seed=SEED):
    """The mix itself, a row per slot: shard, number of the source, ``j``, and ``tokens``, the words of the block."""
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    hashed = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    texts = docs.select(F.col(doc_id).alias("_id"), hashed.alias("_hash"), words.alias("_words")).dropDuplicates(
        ["_id", "_hash"]
    )
    same = placed["doc_id"].eqNullSafe(texts["_id"]) & (placed["hash"] == texts["_hash"])
    first, end = F.col("first"), F.col("first") + F.col("size")
    numbers = F.sequence(F.floor(first / block_words), F.floor((end - 1) / block_words))

    def cut(block):
        begin, stop = F.greatest(block * block_words, first), F.least((block + 1) * block_words, end)
        part = F.slice("_words", (begin - first + 1).cast("int"), (stop - begin).cast("int"))
        return F.struct(block.alias("block"), (begin - block * block_words).alias("place"), part.alias("part"))

    # a text is cut once, however many blocks it lies in
    pieces = placed.where(F.col("size") > 0).join(texts, same).select("number", F.explode(F.transform(numbers, cut)).alias("cut"))
    gathered = F.sort_array(F.collect_list(F.struct("cut.place", "cut.part")))
    blocks = pieces.groupBy("number", "cut.block").agg(gathered.alias("parts"))
    met = slots.join(blocks, ["number", "block"])
    return met.select("shard", "number", "j", F.slice(F.flatten("parts.part"), 1, F.col("words").cast("int")).alias("tokens"))


def mixing_report(docs, doc_id="doc_id", text="text", source="source"):
    """One row per document: its size, its source's size and target, and the words of it that the mix takes."""
    placed, slots = plan_mix(docs, doc_id, text, source)
    taken = words_taken(placed, slots)
    return taken.select("doc_id", "size", "source_size", "target", "taken")
