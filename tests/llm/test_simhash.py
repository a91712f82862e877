"""Fingerprints and components against brute force."""

import re
from collections import Counter

import pytest
import xxhash

from rastro.llm import simhash


def fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=4):
    """Least id of each print's component."""
    distinct = sorted(set(prints.values()))
    parent = {p: p for p in distinct}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    least = {}
    for doc, p in prints.items():
        r = root(p)
        least[r] = min(least.get(r, doc), doc)
    return {doc: least[root(p)] for doc, p in prints.items()}


def test_report_matches_brute_force(documents, make_docs):
    extra = [(900, None), (901, ""), (902, " \n\t"), (903, "One"), (904, "oNE two"), (905, "a b c d"), (906, "x " * 600000)]
    docs = documents.unionByName(make_docs(extra))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    prints = {d: fingerprint(t) for d, t in texts.items()}
    least = components(prints)
    found = simhash.near_duplicate_report(docs).collect()
    assert Counter(found) == Counter((d, f"{prints[d]:016x}", least[d]) for d in texts)


def test_links_match_brute_force_in_dense_groups(spark):
    """Chains and clouds around few centres: links through buckets that hold several components."""
    import random

    rng = random.Random(5)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        values.add(centre)
        for _ in range(60):
            v = centre
            for _ in range(rng.randint(1, 6)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values |= {rng.getrandbits(64) for _ in range(300)} | {0, 1, 31, (1 << 64) - 1}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    rows = spark.createDataFrame(list(enumerate(signed)), "doc_id long, _print long")
    found = {r._print: r.component_id for r in simhash.print_components(rows).collect()}
    least = components(dict(enumerate(values)))
    assert found == {signed[i]: least[i] for i in range(len(values))}


@pytest.mark.parametrize("radius", [0, 2])
def test_smaller_radius(spark, radius):
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, 7), (4, 1023)], "doc_id long, _print long")
    found = {r._print: r.component_id for r in simhash.print_components(rows, radius=radius).collect()}
    assert found == ({0: 1, 1: 2, 7: 3, 1023: 4} if radius == 0 else {0: 1, 1: 1, 7: 1, 1023: 4})


def test_keep_one_of_each(make_docs):
    text = "some words that are long enough to be a text of its own kind here"
    docs = make_docs([(5, text), (3, text), (3, text), (None, text), (8, "another text altogether, with other words"), (None, None), (None, "")])
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) in (
        Counter([(3, text), (8, "another text altogether, with other words"), (None, None)]),
        Counter([(3, text), (8, "another text altogether, with other words"), (None, "")]),
    )


def test_empty(make_docs):
    assert simhash.near_duplicate_report(make_docs([])).count() == 0
