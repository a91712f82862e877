"""Operator 3, exact substring deduplication with suffix arrays and deep-shallow sorting.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller id. All
suffixes of a corpus cannot be sorted in one place, so they are dealt out by their heads: each string of
``LENGTH`` bytes is named by its *anchor*, the least of the hashes of its strings of ``GRAM`` bytes. Equal
strings have equal anchors, whatever surrounds them, and strings that follow each other mostly share one, so
a *run* of them travels together as one stretch of text. Suffixes with equal heads hence meet in one bucket
of anchors, and each bucket is sorted by itself:

* first only anchors travel, six bytes or so each; runs whose anchor occurs nowhere else are done with;
* equal runs are one entry; a task sends each run once, however often a passage occurs in its texts;
* shallow: multikey quicksort by symbols of eight bytes. All groups that are equal so far are split by their next
  symbol in one array operation, down to ``SHALLOW`` bytes;
* deep: the groups that remain have long common prefixes. A blind trie (a trie with only its branches, each with
  the depth of its first difference) orders each of them: the depth is the least common prefix with the
  group's first suffix, and bytes in between are skipped. Groups that reach ``LENGTH`` bytes are equal strings.

The least id of a group decides for all its members. The removed stretches go back to the texts by document.

Anchors that very many documents share (a passage on a third of all pages) are found in a sample of documents, and
their strings are dealt by a hash of the whole string instead, so no bucket grows with such a passage. That
steers only where strings are compared; the result is the same for any list.

Defined results: a null text has no bytes. Rows with equal ids do not remove from each other; rows that
are the same in id and text get the same result each. A null id counts as larger than all ids. A text of
fewer than ``LENGTH`` bytes stays whole.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rastro.llm.packing import (
    TEXTS,
    batch_texts,
    columns_of,
    compressed,
    cuts,
    decompressed,
    documents_of,
    pack,
    pack_texts,
    unpack,
)
from rastro.llm.workers import find_package

LENGTH = 50
GRAM = 20
SHALLOW = 16
#: Bytes of a run at most: all its strings hold one anchor.
STRETCH = 2 * LENGTH - GRAM
#: Bytes of text that are hashed at once.
CHUNK = 1 << 20
#: Bytes of text per bucket of suffixes, and per part of texts.
BUCKET_BYTES, PART_BYTES = 16 << 20, 4 << 20
#: An anchor is hot if it occurs in this share of a sample of about so many documents; so the number of hot
#: anchors is at most 1 / share times the anchors of a document.
HOT_SHARE = 0.01
HOT_SAMPLE = 3000
NULL_ID = np.iinfo(np.int64).max

_MIX = np.uint64(0x9E3779B97F4A7C15)
_POSITION = np.uint64((1 << 24) - 1)


def _symbols(data, count):
    """The eight bytes from each of the first ``count`` places, as a number that orders like them."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((count,), ">u8", padded.data, 0, (1,)).astype(np.uint64)


def _mixed(h):
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _gram_hashes(data):
    """A hash of the ``GRAM`` bytes from each place that has as many."""
    count = len(data) - GRAM + 1
    words = _symbols(data, len(data) - 7)
    found = _mixed(words[:count])
    for at in (*range(8, GRAM - 8, 8), GRAM - 8):
        found = _mixed(found * _MIX ^ words[at : at + count])
    return found


def _sliding_least(values, width):
    """Least of each ``width`` neighbours."""
    have, least = 1, values
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


def anchor_runs(data, starts, stops):
    """Runs of the strings in ``data[start:stop]`` of several documents.

    Returns, per run: document, place of its first string, number of strings, anchor.
    """
    if len(data) < LENGTH:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    hashes = _gram_hashes(data)
    places = np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_least((hashes & ~_POSITION) | places, LENGTH - GRAM + 1)
    anchor_at = (least & _POSITION).astype(np.int64)
    strings = np.maximum(stops - starts - LENGTH + 1, 0)
    row = np.repeat(np.arange(len(starts)), strings)
    at = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings) + starts[row]
    anchor_at = anchor_at[at]
    new = np.ones(len(row), bool)
    new[1:] = (anchor_at[1:] != anchor_at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(row)))
    return row[first], at[first], sizes, hashes[anchor_at[first]]


def _stretches(data, at, sizes):
    """The bytes of each run, padded with zeros to ``STRETCH``."""
    padded = np.concatenate([data, np.zeros(STRETCH, np.uint8)])
    bytes_ = np.lib.stride_tricks.sliding_window_view(padded, STRETCH)[at]
    bytes_[np.arange(STRETCH) >= (sizes + LENGTH - 1)[:, None]] = 0
    return bytes_


def _fingerprints(stretches, sizes):
    """A hash of each run, to find candidates for equal ones."""
    words = np.ascontiguousarray(np.pad(stretches, ((0, 0), (0, -stretches.shape[1] % 8)))).view(np.uint64)
    return reduce(lambda h, i: _mixed(h * _MIX + words[:, i]), range(words.shape[1]), sizes.astype(np.uint64))


def _equal_runs(stretches, sizes):
    """Number of the group of equal runs of each run; equality is of all bytes."""
    prints = _fingerprints(stretches, sizes)
    order = np.argsort(prints, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = (prints[order][1:] != prints[order][:-1]) | (sizes[order][1:] != sizes[order][:-1])
    alike = np.flatnonzero(~new)
    new[alike] = (stretches[order[alike]] != stretches[order[alike - 1]]).any(axis=1)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group


def _least_of(group, ids):
    least = np.full(group.max(initial=-1) + 1, NULL_ID)
    np.minimum.at(least, group, ids)
    return least


# --- sorting -----------------------------------------------------------------------------


def _regroup(order, group, keys):
    """Split the groups of ``order`` by ``keys``; returns the new order and group numbers."""
    arranged = np.lexsort((keys, group))
    order, group, keys = order[arranged], group[arranged], keys[arranged]
    new = np.ones(len(order), bool)
    new[1:] = (group[1:] != group[:-1]) | (keys[1:] != keys[:-1])
    return order, np.cumsum(new) - 1


def _apart(order, group):
    """Members of groups of more than one."""
    sizes = np.bincount(group)
    return sizes[group] > 1


def _common_prefix(a, b):
    """Length of the common prefix of the rows of two byte matrices."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def equal_heads(suffixes):
    """Groups of equal rows among ``suffixes``, a matrix of heads of suffixes.

    Returns the rows that equal another row, and the number of the group of each.
    """
    width = suffixes.shape[1]
    order = np.arange(len(suffixes))
    group = np.zeros(len(suffixes), np.int64)
    for depth in range(0, SHALLOW, 8):
        symbols = np.ascontiguousarray(suffixes[order, depth : depth + 8]).view(">u8").ravel().astype(np.uint64)
        order, group = _regroup(order, group, symbols)
        keep = _apart(order, group)
        order, group = order[keep], group[keep]
    done_rows, done_groups, n_done = [], [], 0
    while len(order):
        # blind tries: every group branches at the first byte that its members do not share
        group = np.cumsum(np.append(True, group[1:] != group[:-1])) - 1
        firsts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        leaders = suffixes[order[firsts]][group]
        depth = np.minimum.reduceat(_common_prefix(suffixes[order], leaders), firsts)
        equal = (depth == width)[group]
        done_rows.append(order[equal])
        numbers = np.cumsum(depth == width) - 1
        done_groups.append(numbers[group[equal]] + n_done)
        n_done += int((depth == width).sum())
        order, group = order[~equal], group[~equal]
        if len(order):
            branch = suffixes[order, depth[group]]
            order, group = _regroup(order, group, branch)
            keep = _apart(order, group)
            order, group = order[keep], group[keep]
    if not done_rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(done_rows), np.concatenate(done_groups)


def _ranges(sizes):
    """0 .. size-1 for each size, in a row."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


#: Suffixes that are sorted at once.
SORTED_AT_ONCE = 1 << 19


def removed_in_bucket(key, ids, sizes, stretches):
    """Which strings of the runs of a bucket go.

    ``key`` groups the runs that may share strings. Returns (run, first string, strings) of stretches that go.
    """
    found = []
    group = _equal_runs(stretches, sizes)
    least = _least_of(group, ids)
    copies = np.flatnonzero(ids > least[group])
    found.append((copies, np.zeros(len(copies), np.int64), sizes[copies]))
    # one run of each group, in the document with its least id, is compared with the others of its key
    firsts = np.flatnonzero(ids == least[group])
    _, shown = np.unique(group[firsts], return_index=True)
    shown = firsts[shown]
    keys, of_key = np.unique(key[shown], return_inverse=True)
    low, high = np.full(len(keys), NULL_ID), np.full(len(keys), np.iinfo(np.int64).min)
    np.minimum.at(low, of_key, ids[shown])
    np.maximum.at(high, of_key, ids[shown])
    shared = shown[(low < high)[of_key]]
    shared = shared[np.argsort(key[shared], kind="stable")]
    ends = np.cumsum(sizes[shared])
    marks_run, marks_at = [], []
    begin = 0
    while begin < len(shared):
        stop = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + SORTED_AT_ONCE)) + 1
        # runs of one key stay together
        stop = int(np.searchsorted(key[shared], key[shared[min(stop, len(shared)) - 1]], side="right"))
        some = shared[begin:stop]
        run, offset = np.repeat(some, sizes[some]), _ranges(sizes[some])
        flat = stretches.reshape(-1)
        heads = np.lib.stride_tricks.sliding_window_view(flat, LENGTH)[run * STRETCH + offset]
        rows, equal = equal_heads(heads)
        smallest = _least_of(equal, ids[run[rows]])
        later = ids[run[rows]] > smallest[equal]
        marks_run.append(run[rows[later]])
        marks_at.append(offset[rows[later]])
        begin = stop
    if marks_run:
        run, offset = np.concatenate(marks_run), np.concatenate(marks_at)
        # what goes from the shown run goes from its copies in the same document too
        same = np.flatnonzero(ids == least[group])
        same = same[np.argsort(group[same], kind="stable")]
        per_group = np.bincount(group, minlength=len(least)) - np.bincount(group[copies], minlength=len(least))
        first_of = np.cumsum(per_group) - per_group
        times = per_group[group[run]]
        every = same[np.repeat(first_of[group[run]], times) + _ranges(times)]
        offset = np.repeat(offset, times)
        order = np.lexsort((offset, every))
        every, offset = every[order], offset[order]
        new = np.ones(len(every), bool)
        new[1:] = (every[1:] != every[:-1]) | (offset[1:] != offset[:-1] + 1)
        at = np.flatnonzero(new)
        found.append((every[at], offset[at], np.diff(np.append(at, len(every)))))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


# --- moving the runs ------------------------------------------------------------------------

_ANCHORS = "bucket bigint, part bigint, n bigint, keys binary, runs binary"
_SHARED = "part bigint, n bigint, runs binary"
_RUNS = (
    "bucket bigint, part bigint, known boolean, n bigint, rows binary, ids binary, at binary, sizes binary, "
    "keys binary, size bigint, stretches binary"
)
_REMOVED = "part bigint, n bigint, rows binary, at binary, sizes binary"
_CLEANED = "doc_id bigint, n_bytes bigint, kept binary, removed array<struct<start:bigint,stop:bigint>>"


def _groups_of_texts(offsets):
    """Consecutive documents of about ``CHUNK`` bytes together; places must fit into 24 bits."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


def _pieces(data, starts, stops):
    """Texts beyond ``CHUNK`` are cut into overlapping pieces, so that no string is lost."""
    if len(data) <= 2 * CHUNK:
        yield data, starts, stops, 0
        return
    for at in range(0, len(data) - LENGTH + 1, CHUNK):
        end = min(at + CHUNK + LENGTH - 1, len(data))
        yield data[at:end], np.array([0]), np.array([end - at]), at


def _all_runs(data, offsets):
    """``anchor_runs`` of all documents, hashed a chunk at a time."""
    found = [tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))]
    for first, last in _groups_of_texts(offsets):
        start = offsets[first]
        texts = data[start : offsets[last]]
        borders = offsets[first : last + 1] - start
        for piece, begin, end, shift in _pieces(texts, borders[:-1], borders[1:]):
            doc, at, sizes, key = anchor_runs(piece, begin, end)
            found.append((doc + first, at + shift + start, sizes, key))
    return tuple(np.concatenate(arrays) for arrays in zip(*found))


def _is_hot(key, hot):
    known = np.frombuffer(hot.value, np.uint64)
    if not len(known):
        return np.zeros(len(key), bool)
    return known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key


#: Bits of an anchor that are compared to find out which occur twice; equal bits of others do no harm.
_SEEN_BITS = np.uint64(16)


def _send_anchors(n_buckets, hot):
    """Of every run the anchor and the run's number in its part."""

    def run(table):
        _, data, offsets = documents_of(table)
        part = table.column("part")[0].as_py()
        _, _, _, key = _all_runs(data, offsets)
        runs = np.flatnonzero(~_is_hot(key, hot))
        bucket = (_mixed(key[runs]) % np.uint64(n_buckets)).astype(np.int64)
        seen = key[runs] >> _SEEN_BITS
        order = np.lexsort((seen, bucket))
        runs, bucket, seen = runs[order], bucket[order], seen[order]
        found = {"bucket": [], "part": [], "n": [], "keys": [], "runs": []}
        for a, b in cuts(bucket):
            gaps = np.diff(seen[a:b], prepend=np.uint64(0))
            for name, value in zip(found, (bucket[a], part, b - a, pack(gaps), pack(runs[a:b].astype(np.uint32)))):
                found[name].append(value)
        return columns_of(_ANCHORS, found)

    return run


def _find_shared(table):
    """For each part the numbers of its runs whose anchor occurs again, there or elsewhere."""
    parts = table.to_pylist()
    seen = np.concatenate([np.cumsum(unpack(p["keys"], p["n"], np.uint64)) for p in parts])
    order = np.argsort(seen, kind="stable")
    same = np.append(False, seen[order][1:] == seen[order][:-1])
    again = np.empty(len(seen), bool)
    again[order] = same | np.append(same[1:], False)
    found, begin = {"part": [], "n": [], "runs": []}, 0
    for p in parts:
        runs = np.sort(unpack(p["runs"], p["n"], np.uint32)[again[begin : begin + p["n"]]])
        begin += p["n"]
        for name, value in zip(found, (p["part"], len(runs), pack(np.diff(runs, prepend=np.uint32(0))))):
            found[name].append(value)
    return columns_of(_SHARED, found)


def _send_runs(n_buckets, hot):
    """The runs of shared anchors, with their bytes, to the bucket of their anchor."""

    def run(texts, shared):
        ids, data, offsets = documents_of(texts)
        part = texts.column("part")[0].as_py()
        doc, at, sizes, key = _all_runs(data, offsets)
        is_hot = _is_hot(key, hot)
        chosen = np.zeros(len(key), bool)
        for p in shared.to_pylist():
            chosen[np.cumsum(unpack(p["runs"], p["n"], np.uint32))] = True
        chosen |= is_hot
        doc, at, sizes, key, is_hot = (x[chosen] for x in (doc, at, sizes, key, is_hot))
        later = _has_copy_before(data, ids, doc, at, sizes)
        gone = [(doc[later], at[later], sizes[later])]
        doc, at, sizes, key, is_hot = (x[~later] for x in (doc, at, sizes, key, is_hot))
        # strings of hot anchors go by themselves, dealt by all their bytes
        n = sizes[is_hot]
        alone = np.repeat(at[is_hot], n) + _ranges(n)
        ones = np.ones(len(alone), np.int64)
        alone_doc = np.repeat(doc[is_hot], n)
        later = _has_copy_before(data, ids, alone_doc, alone, ones)
        gone.append((alone_doc[later], alone[later], ones[later]))
        alone, alone_doc, ones = alone[~later], alone_doc[~later], ones[~later]
        alone_key = _fingerprints(_stretches(data, alone, ones), ones)
        doc, at = np.concatenate([doc[~is_hot], alone_doc]), np.concatenate([at[~is_hot], alone])
        sizes, key = np.concatenate([sizes[~is_hot], ones]), np.concatenate([key[~is_hot], alone_key])
        found = {name: [] for name in (f.split()[0] for f in _RUNS.split(", "))}

        def add(bucket, known, own, stretches, joined=None):
            rows, place, size = joined or (doc[own], at[own] - offsets[doc[own]], sizes[own])
            bytes_ = stretches.tobytes()
            values = (
                bucket, part, known, len(rows), pack(rows), pack(ids[doc[own]]), pack(place), pack(size),
                pack(np.diff(key[own], prepend=np.uint64(0))), len(bytes_), compressed(bytes_),
            )
            for name, value in zip(found, values):
                found[name].append(value)

        # what has a copy with a smaller id right here goes, and need not be compared with anything
        gone_doc, gone_at, gone_sizes = (np.concatenate(x) for x in zip(*gone))
        if len(gone_doc):
            joined = _joined(gone_doc, gone_at - offsets[gone_doc], gone_sizes)
            add(part % n_buckets, True, gone_doc[:0], np.empty(0, np.uint8), joined)
        bucket = (_mixed(key) % np.uint64(n_buckets)).astype(np.int64)
        kept = np.lexsort((key, bucket))
        for a, b in cuts(bucket[kept]):
            own = kept[a:b]
            add(bucket[own[0]], False, own, _stretches(data, at[own], sizes[own]))
        pa.default_memory_pool().release_unused()
        return columns_of(_RUNS, found)

    return run


def _has_copy_before(data, ids, doc, at, sizes):
    """Runs that a document of the same part with a smaller id has too."""
    group = _equal_runs(_stretches(data, at, sizes), sizes)
    return ids[doc] > _least_of(group, ids[doc])[group]


def _joined(rows, at, sizes):
    """Runs of strings that follow each other in one document as one."""
    order = np.lexsort((at, rows))
    rows, at, sizes = rows[order], at[order], sizes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (at[1:] != at[:-1] + sizes[:-1])
    first = np.flatnonzero(new)
    return rows[first], at[first], np.add.reduceat(sizes, first) if len(first) else sizes


def _sort_bucket(table):
    """The stretches of texts that go, by part."""
    every = table.to_pylist()
    parts = [p for p in every if not p["known"]]
    empty = np.empty(0, np.int64)

    def whole(name, parts):
        return np.concatenate([empty, *(unpack(p[name], p["n"], np.int64) for p in parts)])

    stretches = [np.frombuffer(decompressed(p["stretches"], p["size"]), np.uint8) for p in parts]
    stretches = np.concatenate([np.empty(0, np.uint8), *stretches]).reshape(-1, STRETCH)
    keys = [np.cumsum(unpack(p["keys"], p["n"], np.uint64)) for p in parts]
    keys = np.concatenate([np.empty(0, np.uint64), *keys])
    rows, ids, at, sizes = (whole(name, parts) for name in ("rows", "ids", "at", "sizes"))
    part = np.repeat([p["part"] for p in parts], [p["n"] for p in parts]).astype(np.int64)
    run, offset, strings = removed_in_bucket(keys, ids, sizes, stretches)
    part, rows, at = part[run], rows[run], at[run] + offset
    found = {"part": [], "n": [], "rows": [], "at": [], "sizes": []}

    def add(number, joined):
        for name, value in zip(found, (number, len(joined[0]), *map(pack, joined))):
            found[name].append(value)

    order = np.argsort(part, kind="stable")
    for a, b in cuts(part[order]):
        own = order[a:b]
        add(part[own[0]], _joined(rows[own], at[own], strings[own]))
    for p in every:
        if p["known"]:
            add(p["part"], [unpack(p[name], p["n"], np.int64) for name in ("rows", "at", "sizes")])
    return columns_of(_REMOVED, found)


def _without(data, spans):
    kept, upto = [], 0
    for start, stop in spans:
        kept.append(data[upto:start])
        upto = stop
    kept.append(data[upto:])
    return b"".join(kept)


def _clean(texts, removed):
    """Texts of a part without the stretches that go, and where these were."""
    parts = removed.to_pylist()

    def whole(name):
        return np.concatenate([np.empty(0, np.int64), *(unpack(p[name], p["n"], np.int64) for p in parts)])

    rows, at, sizes = whole("rows"), whole("at"), whole("sizes")
    order = np.lexsort((at, rows))
    rows, at, stops = rows[order], at[order], (at + sizes + LENGTH - 1)[order]
    ids, data, offsets = documents_of(texts)
    borders = np.searchsorted(rows, np.arange(len(ids) + 1))
    found = [[], [], [], []]
    for i, doc_id in enumerate(ids.tolist()):
        spans = []
        a, b = borders[i], borders[i + 1]
        for start, stop in zip(at[a:b].tolist(), stops[a:b].tolist()):
            if spans and start <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], stop)
            else:
                spans.append([start, stop])
        text = data[offsets[i] : offsets[i + 1]].tobytes()
        found[0].append(None if doc_id == NULL_ID else doc_id)
        found[1].append(len(text))
        found[2].append(_without(text, spans))
        found[3].append([{"start": start, "stop": stop} for start, stop in spans])
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    types = (pa.int64(), pa.int64(), pa.binary(), spans)
    return pa.table([pa.array(c, t) for c, t in zip(found, types)], names=["doc_id", "n_bytes", "kept", "removed"])


def _hot_anchors(sample):
    """Anchors in a large share of a sample of the documents; bounded by that share."""

    def anchors(batches):
        for batch in batches:
            data, offsets = batch_texts(batch, 0)
            doc, _, _, key = _all_runs(data, offsets)
            pairs = np.unique(np.stack([doc.astype(np.uint64), key], axis=1), axis=0)
            keys, counts = np.unique(pairs[:, 1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["anchor", "n"])

    counted = sample.mapInArrow(anchors, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))
    hot = counted.where(F.col("n") >= max(HOT_SHARE * HOT_SAMPLE, 2)).select("anchor").collect()
    return np.sort(np.array([r.anchor for r in hot], np.int64).view(np.uint64))


def remove_repeats(docs, doc_id="doc_id", text="text"):
    """One row per document: ``doc_id``, ``n_bytes``, ``kept`` (bytes), ``removed`` (stretches of bytes).

    Counts the bytes, and looks for hot anchors in the sample, when called.
    """
    spark = docs.sparkSession
    find_package(spark)
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    order = F.coalesce(F.col(doc_id).cast("long"), F.lit(int(NULL_ID)))
    rows = docs.select(F.xxhash64(order, data).alias("row"), order.alias("order"), data.alias("data"))
    n_docs, n_bytes = docs.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))
    ).first()
    n_buckets = int(n_bytes) // BUCKET_BYTES + 1
    n_parts = int(n_bytes) // PART_BYTES + 1
    every = max(int(n_docs) // HOT_SAMPLE, 1)
    sample = rows.where(F.pmod("row", F.lit(every)) == 0).select("data")
    hot = spark.sparkContext.broadcast(_hot_anchors(sample).tobytes())
    # the shuffle by part is made once; all three steps that need texts read it
    texts = rows.mapInArrow(pack_texts(n_parts), TEXTS).groupBy("part")
    anchors = texts.applyInArrow(_send_anchors(n_buckets, hot), _ANCHORS)
    shared = anchors.groupBy("bucket").applyInArrow(_find_shared, _SHARED)
    runs = texts.cogroup(shared.groupBy("part")).applyInArrow(_send_runs(n_buckets, hot), _RUNS)
    removed = runs.groupBy("bucket").applyInArrow(_sort_bucket, _REMOVED)
    return texts.cogroup(removed.groupBy("part")).applyInArrow(_clean, _CLEANED)


def repeat_report(docs, doc_id="doc_id", text="text"):
    """One row per document: bytes, bytes removed, stretches removed and a digest of the rest."""
    return remove_repeats(docs, doc_id, text).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
