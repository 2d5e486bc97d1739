from __future__ import annotations

import re

import duckdb
import pytest

from authorlink.llm import mixing
from tests.llm.conftest import rows_of
from tests.llm.texts import documents, prose


def _targets(sizes: dict) -> dict:
    """Shared out step by step, as the rule is told."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, full = dict.fromkeys(sizes, 0.0), set()
    rest = 1.5 * sum(sizes.values())
    while rest > 1e-9 and len(full) < len(sizes):
        total = sum(weight[s] for s in sizes if s not in full)
        share = {s: rest * weight[s] / total for s in sizes if s not in full}
        rest = 0.0
        for s, more in share.items():
            target[s] += more
            if target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                full.add(s)
    return target


def test_targets_taken_and_oracle(spark, folder):
    docs = [*documents(), *((100 + i, prose(20 + i % 90, i), "en", "abcdefg"[i % 7] if i % 11 else None) for i in range(400))]
    sf = folder(docs, extra=True)
    out = rows_of(mixing.op3_source_mixing(spark, sf))
    assert len(out) == len(docs)
    sizes: dict = {}
    for _, text, _, source in docs:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = _targets(sizes)
    seen = {}
    for doc_id, size, source_size, target, taken in out:
        assert taken in (0, size, 2 * size)
        seen[source_size] = target
    for source, size in sizes.items():
        assert seen[size] == pytest.approx(want[source])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    assert sorted(con.execute(mixing.OP3_SQL).fetchall(), key=repr) == sorted(out, key=repr)
    assert sorted(rows_of(mixing.op3_source_mixing(spark, sf)), key=repr) == sorted(out, key=repr)


def test_taken_comes_near_the_target(spark, folder):
    docs = [(i, "w " * (5 + i % 13), "en", "abc"[i % 3] if i % 2 else "big") for i in range(6000)]
    rows = rows_of(mixing.op3_source_mixing(spark, folder(docs)))
    taken, target = {}, {}
    for (_, _, _, source), (_, _, _, aim, n) in zip(docs, sorted(rows)):
        taken[source] = taken.get(source, 0) + n
        target[source] = aim
    assert all(abs(taken[s] / target[s] - 1) < 0.05 for s in target)


def test_no_words_and_no_rows(spark, folder):
    rows = rows_of(mixing.op3_source_mixing(spark, folder([(1, None, None, "a"), (2, "", None, None)])))
    assert sorted(rows) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.op3_source_mixing(spark, folder([])).count() == 0


def test_emitted_keeps_the_columns(spark, folder):
    sf = folder([(1, "a b", None, "x"), (2, "c d", None, "x")], extra=True)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mixed = mixing.mix(docs)
    want = sum(r.copies for r in mixed.collect())
    assert mixing.emitted(mixed).count() == want
