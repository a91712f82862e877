"""Encoding against the public library, exact round trips, appends and edits."""

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken

from rastro.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as file:
        return bpe.Vocabulary.from_tiktoken(file.read())


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def sha(data):
    return hashlib.sha256(data).hexdigest()


def texts():
    rng = random.Random(3)
    letters = "".join(chr(c) for c in range(0x250)) + "日本語한국어кириллицаעברית👍🏽́ 　 \x85"
    yield from ["", " ", "  \n\n x", "it's they'll I'D 'em", "a" * 5000, " " * 3000 + "x", "\x1c\x1d\x1e\x1f a"]
    yield "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c % 7 == 0)
    for _ in range(60):
        yield "".join(rng.choice(letters) for _ in range(rng.randrange(200)))


def test_report_matches_library(documents, make_docs, library):
    extra = [(1000 + i, t) for i, t in enumerate(texts())] + [(None, None), (None, "x"), (1001, " ")]
    docs = documents.unionByName(make_docs(extra))

    def expected(doc_id, text):
        ids = library.encode_ordinary(text or "")
        return doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())

    wanted = Counter(expected(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert Counter(map(tuple, bpe.bpe_report(docs, PATH, P.PATTERN).collect())) == wanted


def test_pieces_match_library(vocabulary, library):
    rng = random.Random(1)
    letters = b" abcdefghinorstu\xc3\xa9\xe4\xb8\xad"
    pieces = {bytes(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(3000)}
    found = bpe.encode_pieces(vocabulary, pieces)
    assert found == {piece: library._encode_single_piece(piece) for piece in pieces}


def test_appends_and_edits_equal_a_fresh_encoding(vocabulary):
    rng = random.Random(2)
    text = ("the internationalisation of understanding " * 9).encode()
    grown = bpe.PrefixEncoding(vocabulary, text[:5])
    for i in range(5, len(text), 7):
        grown.append(text[i : i + 7])
    assert grown.tokens() == bpe.PrefixEncoding(vocabulary, text).tokens()
    for _ in range(40):
        start = rng.randrange(len(grown.data))
        stop = min(start + rng.randrange(12), len(grown.data))
        grown.replace(start, stop, bytes(rng.choice(b"aeinst ") for _ in range(rng.randrange(9))))
        assert grown.last == bpe.PrefixEncoding(vocabulary, bytes(grown.data)).last


def test_other_columns_and_empty_tables(make_docs):
    docs = make_docs([(1, "two words")]).selectExpr("*", "7 AS decoded_too", "'x' AS kind")
    row = bpe.encode_documents(docs, PATH, P.PATTERN, drop_text=False).first()
    assert row.text == "two words" and row.kind == "x" and len(row.ids) == 2
    assert bpe.bpe_report(docs.limit(0), PATH, P.PATTERN).count() == 0
