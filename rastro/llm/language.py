"""Operator 6, language identification by cross-parsing entropy.

For every language a suffix automaton is built from a bounded sample of labelled text. A text is
parsed greedily against each automaton: a phrase is the longest match, the next begins where it
ends. Text in the automaton's language needs few phrases; each phrase costs the logarithm of the places it
could come from. The language with the fewest phrases, so normalised, wins.

Training texts are those with a language whose crc32(id) mod 4 is not 2. Per language the
``sample_documents`` texts with the smallest hash are taken, and of their joined text ``sample_bytes`` bytes: that is the
bounded sample. Predicting uses the text alone, all of it: bytes are folded to letters and single
spaces, and all rows of a batch are parsed side by side, one byte of each per step.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing
is labelled. Ties go to the language that sorts first. Rows are independent; repeated rows get equal
results. A null id counts as the empty string in crc32.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastro.llm.workers import find_package

SAMPLE_DOCUMENTS = 100
SAMPLE_BYTES = 60_000
#: Every language has an automaton in each worker.
MAX_LANGUAGES = 500
#: Bytes of one text that are parsed in one go; bounds the steps of a batch with one long text.
SEGMENT = 4096

#: Class of every byte: 0 white space and other separators, letters by themselves, upper case folded.
#: Bytes above 127 are parts of letters and signs beyond ASCII and keep their own class.
_CLASSES = np.zeros(256, np.uint8)
_CLASSES[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CLASSES[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_CLASSES[128:] = np.arange(27, 27 + 128)


def fold(data):
    """Classes of bytes, with runs of separators as one."""
    classes = _CLASSES[data]
    keep = np.ones(len(classes), bool)
    keep[1:] = (classes[1:] != 0) | (classes[:-1] != 0)
    return classes[keep]


def suffix_automaton(classes, n_classes):
    """Transition table of the automaton of all substrings; 0 is the start, -1 no transition.

    ``classes`` are numbers below ``n_classes``. The last row is a state without transitions.
    """
    nexts, link, length = [{}], [-1], [0]
    last = 0
    for c in classes.tolist():
        current = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nexts[p]:
            nexts[p][c] = current
            p = link[p]
        if p != -1:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[current] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[current] = clone
        last = current
    table = np.full((len(nexts) + 1, n_classes), -1, np.int32)
    for state, moves in enumerate(nexts):
        for c, target in moves.items():
            table[state, c] = target
    return table


def count_phrases(table, segments, starts, sizes):
    """Phrases of each segment ``segments[start : start + size]``, parsed greedily side by side."""
    phrases = np.zeros(len(starts), np.int64)
    order = np.argsort(-sizes, kind="stable")
    ends = np.sort(sizes)
    dead = len(table) - 1
    state = np.full(len(starts), dead, np.int32)
    begin = starts[order]
    flat, n_classes = table.ravel(), table.shape[1]
    # a byte unknown to the language is a phrase of its own
    start_row = np.where(table[0] < 0, dead, table[0])
    found = np.zeros(len(starts), np.int64)
    for step in range(int(sizes.max(initial=0))):
        active = len(sizes) - np.searchsorted(ends, step, side="right")
        c = segments[begin[:active] + step]
        to = flat[state[:active] * n_classes + c]
        stops = to < 0
        found[:active] += stops
        # the byte that ends a phrase begins the next
        to[stops] = start_row[c[stops]]
        state[:active] = to
    phrases[order] = found
    return phrases


class Languages:
    """The automata of all languages."""

    def __init__(self, samples):
        self.names = sorted(samples)
        folded = [fold(np.frombuffer(samples[n], np.uint8)) for n in self.names]
        # classes that occur in the samples are renumbered, to keep the tables small; the rest is one
        present = np.unique(np.concatenate([np.zeros(1, np.uint8), *folded]))
        self.number = np.full(256, len(present), np.uint8)
        self.number[present] = np.arange(len(present))
        self.tables = [suffix_automaton(self.number[f], len(present) + 1) for f in folded]
        self.costs = [np.log2(len(f) + 2) for f in folded]

    def predict(self, data, starts, stops):
        """Language index and score for each text ``data[start:stop]``; -1 without a letter."""
        texts = [fold(data[a:b]) for a, b in zip(starts, stops)]
        sizes = np.array([len(t) for t in texts], np.int64)
        joined = self.number[np.concatenate([*texts, np.zeros(1, np.uint8)])]
        row_starts = np.cumsum(sizes) - sizes
        pieces = np.maximum(-(-sizes // SEGMENT), 1)
        rows = np.repeat(np.arange(len(sizes)), pieces)
        part = np.arange(len(rows)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = row_starts[rows] + part * SEGMENT
        length = np.minimum(sizes[rows] - part * SEGMENT, SEGMENT)
        cost = np.empty((len(self.names), len(sizes)))
        for i, table in enumerate(self.tables):
            phrases = count_phrases(table, joined, begin, length)
            cost[i] = np.bincount(rows, phrases, len(sizes)) * self.costs[i]
        best = cost.argmin(axis=0)
        least = cost.min(axis=0)
        rest = cost.copy()
        rest[best, np.arange(len(sizes))] = np.inf
        second = rest.min(axis=0)
        # how much more the runner-up costs, as a share; 1 if there is none
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(np.isinf(second), 1.0, 1.0 - least / second)
        return best, np.nan_to_num(score).clip(0.0, 1.0)


def training_samples(docs, doc_id="doc_id", text="text", lang="lang",
                     sample_documents=SAMPLE_DOCUMENTS, sample_bytes=SAMPLE_BYTES):
    """The bounded sample: bytes of text per language, from documents that are not held out.

    First the hash below which a language has ``sample_documents`` documents is found, without reading texts; then
    only those texts are read.
    """
    held_out, rank = _held_out(F.col(doc_id)), F.xxhash64(F.col(doc_id), F.lit(6))
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out)
    first = Window.partitionBy("lang").orderBy("rank")
    limits = (
        labelled.select(F.col(lang).alias("lang"), rank.alias("rank"))
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= sample_documents)
        .groupBy("lang")
        .agg(F.max("rank").alias("limit"))
        .limit(MAX_LANGUAGES + 1)
        .collect()
    )
    if len(limits) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; is {lang!r} a language?")
    if not limits:
        return {}
    limit_of = F.create_map(*[F.lit(x) for r in limits for x in (r.lang, r.limit)])
    chosen = (
        labelled.where(rank <= limit_of[F.col(lang)])
        .select(F.col(lang).alias("lang"), rank.alias("rank"), F.substring(text, 1, sample_bytes).alias("text"))
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("rank", "text")))
        .where(F.col("place") <= sample_documents)
    )
    parts = {}
    for row in chosen.collect():  # at most sample_documents texts of sample_bytes per language
        parts.setdefault(row.lang, []).append((row.rank, row.text))
    found = {}
    for name, texts in parts.items():
        share = max(sample_bytes // len(texts), 1)
        whole = sorted(texts)
        # every text gives its share first, so that one long text does not fill the sample
        joined = b" ".join(t.encode()[: 4 * share] for _, t in whole)
        found[name] = joined[:sample_bytes]
    return found


def _held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


_workers = {}


def _languages(shared):
    key = shared.id
    if key not in _workers:
        _workers.clear()
        _workers[key] = Languages(shared.samples.value)
    return _workers[key]


class _Shared:
    def __init__(self, samples, key):
        self.samples, self.id = samples, key


def _predictor(shared):
    def run(batches):
        languages = _languages(shared)
        names = np.array(languages.names, dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                texts, letters = part.column(part.num_columns - 1), part.column(part.num_columns - 2)
                texts = texts.fill_null("").cast(pa.large_string())
                offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
                data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
                known = letters.to_numpy(zero_copy_only=False).astype(bool) & (len(names) > 0)
                lang = np.full(len(texts), "und", dtype=object)
                score = np.zeros(len(texts))
                if known.any():
                    best, margin = languages.predict(data, offsets[:-1][known], offsets[1:][known])
                    lang[known], score[known] = names[best], margin
                columns = [part.column(i) for i in range(part.num_columns - 2)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(lang, pa.string()), pa.array(score)],
                    [*part.schema.names[:-2], "lang_pred", "score"],
                )

    return run


def identify_languages(docs, samples, text="text"):
    """``docs`` without ``text``, with ``lang_pred`` and ``score``; ``samples`` as from ``training_samples``."""
    find_package(docs.sparkSession)
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(samples), uuid.uuid4().hex)
    kept = docs.drop(text)
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    sent = docs.select(*kept.columns, letters.alias("_letters"), F.col(text).alias("_text"))
    schema = T.StructType(
        [
            *kept.schema.fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return sent.mapInArrow(_predictor(shared), schema)


def language_report(docs, doc_id="doc_id", text="text", lang="lang"):
    """One row per document: whether it is held out, the predicted language and a score from 0 to 1."""
    samples = training_samples(docs, doc_id, text, lang)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), _held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text")
    )
    return identify_languages(rows, samples)
