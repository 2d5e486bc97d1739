from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from authorlink.llm import anchors, suffixes
from tests.llm.conftest import rows_of
from tests.llm.texts import documents, prose


def _brute(docs, span=50):
    first: dict[bytes, int] = {}
    key = lambda i: 2**63 - 1 if i is None else i
    for doc_id, text in docs:
        data = (text or "").encode()
        for p in range(len(data) - span + 1):
            s = data[p : p + span]
            first[s] = min(first.get(s, 2**63), key(doc_id))
    out = []
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - span + 1):
            if first[data[p : p + span]] < key(doc_id):
                gone[p : p + span] = b"\1" * span
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for a, b in zip(b"\0" + bytes(gone), gone) if b and not a)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _shared(n, seed):
    """Documents made of passages that recur, whole, cut short and changed at places."""
    r = random.Random(seed)
    passages = [prose(r.randint(3, 60), 100 + i) for i in range(12)]
    rows = []
    for i in r.sample(range(10_000), n):
        parts = []
        for _ in range(r.randint(1, 5)):
            p = r.choice(passages)
            a = r.randint(0, len(p) // 2)
            parts.append(r.choice([p, p[a:], p[:-a] if a else p, p.replace("e", "E", 1), prose(5, r.random())]))
        rows.append((i, r.choice(["", " ", "é"]).join(parts)))
    return rows


def _same(spark, folder, docs, **options):
    sf = folder(docs, extra=True)
    got = rows_of(suffixes.op5_suffix_dedup(spark, sf))
    want = _brute([d[:2] for d in docs])
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return sum(w[2] for w in want)


def test_edge_cases(spark, folder):
    docs = [d if d[0] != 8 else (8, d[1][:5000], *d[2:]) for d in documents()]
    assert _same(spark, folder, docs)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shared_passages(spark, folder, seed):
    assert _same(spark, folder, _shared(120, seed)) > 1000


def test_long_texts_in_parts(spark, folder, monkeypatch):
    monkeypatch.setattr(anchors, "PART", 700)
    docs = _shared(40, 5)
    docs.append((20_000, " ".join(t for _, t in docs)))
    texts = [t.encode() for _, t in docs]
    starts = {(int(t), int(s) + k) for r in anchors.runs(texts) for t, s, c in zip(r.text, r.start, r.count) for k in range(c)}
    assert starts == {(i, p) for i, t in enumerate(texts) for p in range(len(t) - 49)}


def test_hot_anchors_are_rows_of_their_own(spark, folder):
    docs = _shared(60, 6)
    read = spark.read.parquet(f"{folder(docs)}/documents.parquet")
    usual = {(r.id, r.crc): r for r in suffixes.repeated(read).collect()}
    hot = {(r.id, r.crc): r for r in suffixes.repeated(read, hot=0).collect()}
    assert usual.keys() == hot.keys()
    for (key, a), text in zip(usual.items(), [dict(docs)[k[0]].encode() for k in usual]):
        b = hot[key]
        both = [suffixes._covered(len(text), r.settled, r.found, 50) for r in (a, b)]
        assert (both[0] == both[1]).all()


def test_runs_of_equal_bytes_choose_equal_anchors():
    passage = prose(80, 9).encode()
    a, b = (next(anchors.runs([x])) for x in (b"left " + passage + b" one", passage + b" another"))
    assert set(a.whole.tolist()) & set(b.whole.tolist())
    spans = np.repeat(a.start, a.count)
    assert len(spans) == len(passage) + 9 - 49


def test_empty_table(spark, folder):
    assert suffixes.op5_suffix_dedup(spark, folder([])).count() == 0
