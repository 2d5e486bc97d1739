from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from authorlink.llm import iblt
from tests.llm.conftest import rows_of
from tests.llm.texts import documents, prose


def _paragraphs(text):
    return set(re.findall(iblt.PARAGRAPH, text))


def _likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def _check(spark, folder, docs):
    out = rows_of(iblt.op8_document_fingerprints(spark, folder(docs, extra=True)))
    order = sorted(((d[0] is not None, d[0] or 0, d[1] or ""), d[0], d[1] or "") for d in docs)
    want = []
    for k, (_, doc_id, text) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        share = len(text) // 4
        edited = text[: len(text) - share] + after[:share]
        own = _paragraphs(text)
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), _likeness(own, _paragraphs(edited)), _likeness(own, _paragraphs(after))))
    got = [(r[0], r[1], r[2], r[5], r[6]) for r in out]
    for g, w in zip(sorted(got, key=repr), sorted(want, key=repr)):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:])
    assert len(got) == len(want)
    if len({d[0] for d in docs}) < len(docs):
        return out
    texts = {d[0]: d[1] or "" for d in docs}
    prints = {(texts[r[0]], r[3]) for r in out}
    assert len(prints) == len({t for t, _ in prints})
    return out


def test_edge_cases(spark, folder):
    _check(spark, folder, [d if d[0] != 8 else (8, d[1][:40_000], *d[2:]) for d in documents() if d[0] is not None])


def test_many_buckets(spark, folder, monkeypatch):
    docs = [(i * i, prose(10 + i % 120, i // 2)) for i in range(150)]
    read = spark.read.parquet(f"{folder(docs)}/documents.parquet")
    small = iblt.compared(read, per_bucket=7).select("doc_id", "edited_sha256", "differs_next")
    large = iblt.compared(read, per_bucket=10**6).select("doc_id", "edited_sha256", "differs_next")
    key = lambda rows: sorted((r[0], r[1], sorted(r[2])) for r in rows)
    assert key(small.collect()) == key(large.collect())


def test_null_ids_come_first_and_a_single_document_is_its_own_next(spark, folder):
    out = _check(spark, folder, [(None, "One. Two."), (3, "Three. Four."), (1, "")])
    assert len(out) == 3
    single = _check(spark, folder, [(7, "Alone here. Yes.")])
    assert single[0][6] == 1.0
    assert len(_check(spark, folder, [(None, "a b. c"), (None, "b")])) == 2


def test_peeling_recovers_what_differs_and_larger_sketches_what_is_too_much(spark):
    def run(a, b):
        df = spark.createDataFrame([(a, b)], "a array<bigint>, b array<bigint>")
        cells = [iblt.difference(F.col(c), None, iblt._BASE_BITS, iblt.BASE) for c in "ab"]
        return sorted(df.select(iblt.differing(F.col("a"), F.col("b"), *cells)).first()[0])

    digests = [int.from_bytes(hashlib.sha256(bytes([i % 256, i // 256])).digest()[:8], "big", signed=True) for i in range(700)]
    for a, b in ((digests[:40], digests[2:40]), (digests[:300], digests[200:500]), ([], digests), ([], []), (digests[:3], digests[:3])):
        assert run(a, b) == sorted(set(a) ^ set(b))
    # Digests that share all cells of both sketches can't be told apart there.
    same = [5, 5 + (1 << 62)]
    assert run(same, []) == same


def test_empty_table(spark, folder):
    assert iblt.op8_document_fingerprints(spark, folder([])).count() == 0
