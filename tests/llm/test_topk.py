from __future__ import annotations

import math
import re

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from authorlink.llm import topk
from tests.llm.conftest import rows_of


def _write(path, rows):
    table = pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())), "score": ["x"] * len(rows)})
    pq.write_table(table, path / "embeddings.parquet")
    return str(path)


def _brute(rows):
    usable = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in usable:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:20])]
    return out


def test_query_against_brute_force_and_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topk, "ROW_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    r = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in r.normal(0, 0.4, 8).round(1)]) for i in r.permutation(400)]
    rows += [(1000, None), (1020, [1.0, None] + [0.0] * 6), (1040, [math.nan] * 8), (1060, [math.inf] * 8), (None, [0.1] * 8)]
    rows += [(1080, [0.0] * 8), (1100, [-0.2] * 8)]
    sf = _write(tmp_path, rows)
    got = rows_of(topk.op9_exact_topk(spark, sf))
    assert sorted(got) == sorted(_brute(rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet') WHERE vec_id IS NOT NULL")
    assert sorted(con.execute(topk.OP9_SQL).fetchall()) == sorted(got)


def test_fewer_rows_than_asked_for_and_repeated_rows(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.5, 0.5]), (4, [0.5, 0.5]), (4, [0.5, 0.5])]
    assert sorted(rows_of(topk.op9_exact_topk(spark, _write(tmp_path, rows)))) == sorted(_brute(rows))


def test_scores_beyond_doubles_are_exact(spark):
    big = 2**40 + 1
    df = spark.createDataFrame([(0, [big, 3]), (1, [2**20 + 1, 7]), (2, [2**20 + 1, 8]), (3, [-(2**20), 1])], "vec_id long, v array<long>")
    out = rows_of(topk.top_k(df.where("vec_id = 0"), df, k=2))
    assert sorted(out) == [(0, 1, 2, big * (2**20 + 1) + 24), (0, 2, 1, big * (2**20 + 1) + 21)]


@pytest.mark.parametrize("lists", [1, 2, 3, 50])
def test_any_number_of_lists(spark, lists):
    r = np.random.default_rng(2)
    df = spark.createDataFrame([(i, [int(x) for x in r.integers(-9, 9, 5)]) for i in range(150)], "vec_id long, v array<long>")
    got = rows_of(topk.top_k(df.where("vec_id % 10 = 0"), df, k=5, lists=lists))
    data = dict(rows_of(df))
    for q in range(0, 150, 10):
        best = sorted((-int(np.dot(data[q], v)), i) for i, v in data.items() if i != q)[:5]
        assert [(i, s) for a, _, i, s in sorted(got) if a == q] == [(i, -s) for s, i in best]


def test_empty_table(spark, tmp_path):
    assert topk.op9_exact_topk(spark, _write(tmp_path, [])).count() == 0


def test_blocks_are_never_broadcast(spark):
    # What a copy for each block of the other side takes grows with the square of the data: at 6 GB it was over 2 GB.
    df = spark.createDataFrame([(i, [i, 1]) for i in range(50)], "vec_id long, v array<long>")
    plan = topk.top_k(df, df, k=3)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[q#\d+, ", plan) and not re.search(r"Broadcast\w*Join \[q#\d+, ", plan)


@pytest.mark.parametrize("span", [1, 3, 100])
def test_spans_of_blocks_of_any_width(spark, monkeypatch, span):
    for name, value in (("ROW_BLOCK", 20), ("QUERY_BLOCK", 10), ("SPAN", span), ("PAIRS", 1)):
        monkeypatch.setattr(topk, name, value)
    r = np.random.default_rng(6)
    rows = [(i, [int(x) for x in r.integers(-4, 4, 6) * 10 ** int(r.integers(0, 9))]) for i in range(300)]
    # Ties, and a query that nothing but its own row would suit.
    rows += [(300 + i, [1, 0, 0, 0, 0, 0]) for i in range(40)] + [(400, [3 * 10**9] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = sorted(rows_of(topk.top_k(df.where("vec_id % 10 = 0"), df, k=4)))
    want = []
    for q, a in rows:
        if q % 10 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q)[:4]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == sorted(want)
