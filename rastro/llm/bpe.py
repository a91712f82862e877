"""Operator 5, byte-level BPE: encoding by prefix dynamic programming, and decoding.

Byte pair encoding has this property: for every prefix of a byte string there is exactly one token that
can end the prefix's encoding. It is the token that ends the prefix and may follow the last token of the
rest. Two tokens may follow each other if encoding their joined bytes gives the same two tokens back, which
is decided by undoing merges at the border (``may_follow``). So one array, the last token of every prefix,
holds the encodings of all prefixes; appending bytes extends it, and after an edit it is recomputed
until it agrees with the old one over the length of the longest token.

Spark splits the texts into pieces with a regular expression in the JVM; a task encodes the distinct pieces
of a batch and puts the ids together with array operations. Python keeps the pieces it has met in a bounded
cache. Decoding joins the bytes of the ids. There is no shuffle.

Defined results: a null text is encoded as the empty text, to no ids. Rows are independent; repeated rows
and null ids give a row each.
"""

import base64
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastro.llm.workers import find_package

#: White space as Unicode defines it, written out because Java's \s is ASCII.
_SPACE = r"\t-\r\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Pieces that a worker keeps with their ids.
CACHE = 1 << 16
#: Pairs of tokens that a worker keeps, with whether one may follow the other.
PAIRS = 1 << 17
#: Documents whose pieces are encoded together.
ROWS = 2000


class Vocabulary:
    """Tokens by rank, and which merge makes each of them."""

    def __init__(self, ranks):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks))
        self.merged = {}
        self.follows = {}
        self.left = list(range(size))
        self.right = list(range(size))
        #: tokens that merges can make; others only stand for a whole piece
        self.reachable = {t: r for t, r in ranks.items() if len(t) == 1}
        for rank in sorted(ranks.values()):
            token = self.tokens[rank]
            for cut in range(len(token) - 1, 0, -1):
                a, b = self.reachable.get(token[:cut]), self.reachable.get(token[cut:])
                if a is not None and b is not None and a < rank and b < rank and self.may_follow(a, b):
                    self.merged[a, b] = rank
                    self.left[rank], self.right[rank] = a, b
                    self.reachable[token] = rank
                    break

        #: sizes of the tokens that end in given three (or fewer) bytes, and of those inside these
        found = {}
        for token in self.reachable:
            found.setdefault(token[-3:], set()).add(len(token))
        for end, known in found.items():
            known |= {n for n in range(1, len(end)) if end[-n:] in self.reachable}
        self.sizes = {end: tuple(sorted(known)) for end, known in found.items()}

    @classmethod
    def from_tiktoken(cls, data):
        """From the lines 'base64 rank' of a rank file."""
        lines = (line.split() for line in data.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in lines})

    def may_follow(self, a, b):
        """True if the encoding of both tokens' bytes is these two tokens."""
        left, right, merged = self.left, self.right, self.merged
        limit = len(left)
        while True:
            if merged.get((a, b), limit) < limit:
                return False  # a merge across the border would have come first
            for _ in range(2):
                # undo the later of the two merges; if it is a byte, the other one
                if (a > b) != bool(_):
                    limit, a = a, right[a]
                    if a != limit:
                        break
                else:
                    limit, b = b + 1, left[b]
                    if b + 1 != limit:
                        break
            else:
                return True


def extend_last_tokens(vocabulary, data, last, offset=0):
    """Append to ``last`` the last tokens of the prefixes that it does not reach yet.

    ``data`` holds the bytes from ``offset`` on; at least the longest token's length before the new ones.
    """
    token_of, follows, sizes = vocabulary.reachable.get, vocabulary.follows, vocabulary.sizes
    size_of = len(vocabulary.tokens)
    for end in range(len(last) - offset + 1, len(data) + 1):
        for size in sizes.get(data[max(end - 3, 0) : end]) or sizes.get(data[max(end - 2, 0) : end], (1,)):
            start = end - size
            if start < 0:
                continue
            token = token_of(data[start:end])
            if token is None:
                continue
            if start + offset == 0:
                break
            before = last[start + offset - 1]
            pair = before * size_of + token
            fits = follows.get(pair)
            if fits is None:
                if len(follows) >= PAIRS:
                    follows.clear()
                fits = follows[pair] = vocabulary.may_follow(before, token)
            if fits:
                break
        else:
            raise ValueError("the vocabulary lacks a byte")
        last.append(token)


def tokens_of(vocabulary, last):
    """The tokens of the longest prefix, found from its end."""
    tokens, found, end = vocabulary.tokens, [], len(last)
    while end:
        found.append(last[end - 1])
        end -= len(tokens[found[-1]])
    return found[::-1]


class PrefixEncoding:
    """Encoding of a byte string that can be extended and edited.

    ``last[i]`` is the last token of the encoding of the first ``i + 1`` bytes.
    """

    def __init__(self, vocabulary, data=b""):
        self.vocabulary = vocabulary
        self.data = bytearray()
        self.last = []
        self.append(data)

    def _extend(self, stop):
        offset = max(len(self.last) - self.vocabulary.longest, 0)
        extend_last_tokens(self.vocabulary, bytes(self.data[offset:stop]), self.last, offset)

    def append(self, more):
        self.data += more
        self._extend(len(self.data))

    def replace(self, start, stop, new):
        """Put ``new`` in place of the bytes from ``start`` to ``stop``."""
        rest, known = bytes(self.data[stop:]), self.last[stop:]
        del self.data[start:], self.last[start:]
        self.append(new)
        self.data += rest
        # a last token depends on those of the longest token's length before it
        same = 0
        for i in range(len(rest)):
            if same == self.vocabulary.longest:
                self.last += known[i:]
                return
            self._extend(len(self.last) + 1)
            same = same + 1 if self.last[-1] == known[i] else 0

    def tokens(self):
        return tokens_of(self.vocabulary, self.last)


def encode_pieces(vocabulary, pieces):
    """Ids of each piece (bytes), in a dictionary; a piece that is a token is that token.

    In sorted order, pieces share prefixes with the one before, and so the last tokens of these.
    """
    found, last, before = {}, [], b""
    for piece in sorted(pieces):
        whole = vocabulary.ranks.get(piece)
        if whole is not None:
            found[piece] = [whole]
            continue
        common = 0
        for a, b in zip(before, piece):
            if a != b:
                break
            common += 1
        del last[common:]
        extend_last_tokens(vocabulary, piece, last)
        found[piece] = tokens_of(vocabulary, last)
        before = piece
    return found


_workers = {}


def _vocabulary(shared):
    """The vocabulary of a worker process, with its cache of pieces; made once."""
    data = shared.value
    if data not in _workers:
        _workers.clear()
        _workers[data] = Vocabulary.from_tiktoken(data), {}
    return _workers[data]


def _lists(offsets, values):
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), values)


def _parts(batches):
    """Batches of at most ``ROWS`` rows; memory of the ones before goes back to the system."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)
        del batch
        pa.default_memory_pool().release_unused()


def _encoder(shared, pattern, n_kept):
    def run(batches):
        vocabulary, cache = _vocabulary(shared)
        split = regex.compile(pattern)
        for batch in _parts(batches):
            pieces, texts = batch.column(n_kept), batch.column(n_kept + 1)
            rows = pieces
            if texts.null_count < len(texts):
                both = zip(pieces.to_pylist(), texts.to_pylist())
                rows = pa.array([split.findall(t) if t is not None else p for p, t in both], pa.list_(pa.string()))
            offsets = rows.offsets.to_numpy().astype(np.int64)
            flat = rows.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
            offsets = offsets - offsets[0]
            distinct = flat.dictionary.cast(pa.binary()).to_pylist()
            missing = [piece for piece in distinct if piece not in cache]
            new = encode_pieces(vocabulary, missing)
            ids = [new[piece] if piece in new else cache[piece] for piece in distinct]
            if len(cache) + len(new) > CACHE:
                cache.clear()
            cache.update(islice(new.items(), CACHE))
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            of_piece = pa.array(ids, pa.list_(pa.int32()))
            places = flat.indices.to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes[places])])[offsets]
            values = pc.list_flatten(of_piece.take(flat.indices))
            columns = [batch.column(i) for i in range(n_kept)]
            arrays = [*columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:n_kept], "ids"])

    return run


def encode_documents(docs, vocabulary_path, pattern, text="text", drop_text=True):
    """``docs`` with ``ids``, the token ids of ``text``, an array of integers.

    ``pattern`` splits the text, as for the tokenizer whose ranks are in the file at ``vocabulary_path``;
    that file is read by the driver. The JVM does the splitting. Texts with characters that are
    unassigned in its version of Unicode are split in Python instead.
    """
    find_package(docs.sparkSession)
    with open(vocabulary_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    java = pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")
    whole = F.coalesce(F.col(text), F.lit(""))
    unsure = whole.rlike(r"\p{Cn}")
    kept = docs.drop(text) if drop_text else docs
    sent = docs.select(
        *kept.columns,
        F.when(unsure, F.array().cast("array<string>"))
        .otherwise(F.regexp_extract_all(whole, F.lit(java), F.lit(0)))
        .alias("_pieces"),
        F.when(unsure, whole).alias("_whole"),
    )
    schema = T.StructType([*kept.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return sent.mapInArrow(_encoder(shared, pattern, len(kept.columns)), schema)


def _decoder(shared, at):
    def run(batches):
        vocabulary, _ = _vocabulary(shared)
        tokens = pa.array(vocabulary.tokens, pa.large_binary())
        for batch in _parts(batches):
            ids = batch.column(at)
            offsets = ids.offsets.to_numpy().astype(np.int64)
            values = ids.values.slice(offsets[0], offsets[-1] - offsets[0])
            taken = tokens.take(values)
            ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)[offsets - offsets[0]]
            data = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(ids), [None, pa.py_buffer(ends), taken.buffers()[2]]
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, data.cast(pa.binary())], [*batch.schema.names, "decoded"]
            )

    return run


def decode_documents(encoded, vocabulary_path, ids="ids"):
    """``encoded`` with ``decoded``, the bytes of the ids."""
    find_package(encoded.sparkSession)
    with open(vocabulary_path, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(_decoder(shared, encoded.columns.index(ids)), schema)


def bpe_report(docs, vocabulary_path, pattern, doc_id="doc_id", text="text"):
    """One row per document: number of tokens, and digests of the ids and of the decoded bytes."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    encoded = encode_documents(rows, vocabulary_path, pattern)
    return decode_documents(encoded, vocabulary_path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
