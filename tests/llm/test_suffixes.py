"""Removed bytes against brute force; sorting against Python's."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rastro.llm import suffixes


def brute(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, digest) of each (doc_id, text)."""
    least = {}
    big = 1 << 62
    data = [(big if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in data:
        for i in range(len(b) - length + 1):
            key = b[i : i + length]
            if least.get(key, big + 1) > d:
                least[key] = d
    for (d, b), (doc_id, _) in zip(data, rows):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if least[b[i : i + length]] < d:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        yield doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()


def cases():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    base = " ".join(rng.choice(words) for _ in range(300))
    rows = [(i, None) for i in (1, 2)] + [(3, ""), (4, "x" * 49), (5, "x" * 49), (6, "x" * 50), (7, "x" * 700)]
    for i in range(60):
        own = " ".join(rng.choice(words) for _ in range(rng.randrange(60)))
        rows.append((100 + rng.randrange(60), own + passage[rng.randrange(30) :] + own[::-1]))
    for i in range(25):
        edited = list(base)
        for _ in range(rng.randrange(12)):
            edited[rng.randrange(len(edited))] = rng.choice("xyz ")
        rows.append((300 + i, "".join(edited)))
    rows += [(400, base), (400, base), (400, base + "!"), (None, base), (None, passage), (-5, passage[10:90]), (5, passage)]
    rows += [(500 + i, "ab" * rng.randrange(20, 200)) for i in range(6)]
    return rows


def test_report_matches_brute_force_on_hard_cases(make_docs):
    rows = cases()
    found = suffixes.repeat_report(make_docs(rows)).collect()
    assert Counter(map(tuple, found)) == Counter(brute(rows))


def test_report_matches_brute_force_on_the_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert Counter(map(tuple, suffixes.repeat_report(documents).collect())) == Counter(brute(rows))


@pytest.mark.parametrize("setting", [{"HOT_SHARE": 1.1}, {"CHUNK": 1500, "SORTED_AT_ONCE": 100}, {"HOT_SHARE": 0.0}])
def test_settings_do_not_change_results(make_docs, monkeypatch, setting):
    """Same buckets in process: runs of all texts, sorted with other settings."""
    for name, value in setting.items():
        monkeypatch.setattr(suffixes, name, value)
    rows = [(d, t) for d, t in cases() if d is not None and t]
    data = [t.encode() for _, t in rows]
    hot = np.empty(0, np.uint64)
    if setting.get("HOT_SHARE") == 0.0:
        joined = np.frombuffer(b"".join(data), np.uint8)
        ends = np.cumsum([len(b) for b in data])
        hot = np.unique(suffixes.anchor_runs(joined, ends - [len(b) for b in data], ends)[3])[::2]

    class Shared:
        value = np.sort(hot).tobytes()

    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(rows)), pa.int64()), pa.array([d for d, _ in rows], pa.int64()), pa.array(data, pa.binary())],
        ["row", "order", "data"],
    )

    def grouped(table, name):
        for number in table.column(name).unique().to_pylist():
            yield number, table.filter(pa.compute.equal(table.column(name), number))

    texts = dict(grouped(pa.Table.from_batches(list(suffixes.pack_texts(4)([batch]))), "part"))
    anchors = pa.concat_tables([suffixes._send_anchors(3, Shared)(t) for t in texts.values()])
    shared = [suffixes._find_shared(t) for _, t in grouped(anchors, "bucket")]
    shared = pa.concat_tables([suffixes.columns_of(suffixes._SHARED, {}), *shared])
    runs = []
    for part, t in texts.items():
        own = shared.filter(pa.compute.equal(shared.column("part"), part))
        runs.append(suffixes._send_runs(3, Shared)(t, own))
    removed = pa.concat_tables([suffixes._sort_bucket(t) for _, t in grouped(pa.concat_tables(runs), "bucket")])
    found = []
    for part, t in texts.items():
        own = removed.filter(pa.compute.equal(removed.column("part"), part))
        found += suffixes._clean(t, own).to_pylist()
    found = Counter((r["doc_id"], r["n_bytes"] - len(r["kept"])) for r in found)
    assert found == Counter((r[0], r[2]) for r in brute(rows))


def test_sorting_groups_equal_heads():
    rng = random.Random(9)
    heads = [bytes(rng.choice(b"ab") if i % 17 == 3 else 97 for i in range(50)) for _ in range(400)]
    heads += [bytes(rng.choice(b"abc") for _ in range(50)) for _ in range(200)]
    rows, groups = suffixes.equal_heads(np.array([list(h) for h in heads], np.uint8))
    found = {}
    for r, g in zip(rows.tolist(), groups.tolist()):
        found.setdefault(g, set()).add(r)
    wanted = {}
    for i, h in enumerate(heads):
        wanted.setdefault(h, set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in wanted.values() if len(v) > 1)


def test_empty(make_docs):
    assert suffixes.repeat_report(make_docs([])).count() == 0
