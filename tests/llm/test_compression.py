from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from authorlink.llm import compression as cp
from tests.llm.conftest import rows_of


def _write(path, rows, kind=pa.float32()):
    columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(kind)), pa.array([r[2] for r in rows], pa.int32())]
    table = pa.table(columns, ["vec_id", "embedding", "label"]).append_column("code", pa.array(["x"] * len(rows), pa.string()))
    pq.write_table(table, path / "embeddings.parquet")
    return str(path)


def _brute(rows, float32=True):
    number = (lambda x: float(np.float32(x))) if float32 else float
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(256 * Fraction(number(x))) for x in v], label) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 16) * 16
    size = width // 16
    parts = [[(v + [0] * (width - len(v)))[p * size : (p + 1) * size] for p in range(16)] for _, v, _ in kept]
    books = [[row[p] for row in parts[:64]] for p in range(16)]

    def near(p, part):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(2):
        made = []
        for p in range(16):
            of = [near(p, row[p])[1] for row in parts]
            means = []
            for e, entry in enumerate(books[p]):
                own = [row[p] for row, code in zip(parts, of) if code == e]
                means.append([sum(c) // len(own) for c in zip(*own)] if own else entry)
            made.append(means)
        books = made
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for (i, _, label), row in zip(kept, parts):
        found = [near(p, part) for p, part in enumerate(row)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), min(sum(d for d, _ in found), 2**63 - 1), label))
    total = {label: min(sum(r[2] for r in out if r[3] == label), 2**63 - 1) for *_, label in out}
    return [(*r[:3], total[r[3]], sha) for r in out]


def _rows(n, dims, seed=1, spread=0.4):
    r = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(x)) for x in r.normal(0, spread, dims).round(2)], int(r.integers(0, 3))) for i in r.permutation(n)]


def _key(row):
    return tuple((x is not None, x) if not isinstance(x, str) else (True, x) for x in row)


def test_query_against_brute_force_and_sql(spark, tmp_path):
    rows = _rows(230, 64) + [(300, None, 1), (301, [1.0, None] + [0.0] * 62, 1), (302, [math.nan] * 64, 1), (303, [math.inf] * 64, 2)]
    rows += [(304, [0.25] * 64, None), (305, [-0.25] * 64, None), (306, [0.25] * 64, 7)]
    sf = _write(tmp_path, rows)
    got = rows_of(cp.op12_vector_codes(spark, sf))
    assert sorted(got) == sorted(_brute(rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    assert sorted(con.execute(cp.OP12_SQL).fetchall()) == sorted(got)


@pytest.mark.parametrize("dims", [16, 40, 112])
def test_parts_that_are_no_power_of_two_and_lengths_that_differ(spark, tmp_path, dims):
    rows = _rows(90, dims) + [(200, [0.5] * (dims - 3), 1), (201, [], 1), (202, [0.1] * 5, 2)]
    assert sorted(rows_of(cp.op12_vector_codes(spark, _write(tmp_path, rows)))) == sorted(_brute(rows))


def test_few_equal_and_null_ids(spark, tmp_path):
    rows = [(None, [0.5] * 32, 1), (3, [0.1] * 32, 1), (3, [0.1] * 32, 1), (2, [-0.1] * 32, None), (None, [0.4] * 32, None)]
    got = rows_of(cp.op12_vector_codes(spark, _write(tmp_path, rows)))
    assert sorted(got, key=_key) == sorted(_brute(rows), key=_key)


def test_numbers_beyond_64_bits_are_exact(spark, tmp_path):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) * 10.0 ** float(e) for x, e in zip(r.normal(0, 1, 32), r.integers(-3, 25, 32))], i % 2) for i in range(70)]
    rows += [(100, [1.7e308, -1.7e308] * 16, 5), (101, [2.0**53 + 2] * 32, 6)]
    got = rows_of(cp.op12_vector_codes(spark, _write(tmp_path, rows, pa.float64())))
    assert sorted(got) == sorted(_brute(rows, float32=False))


@pytest.mark.parametrize("m", [1, 2, 4, 8, 32])
def test_coefficients_keep_distances_and_ascend_by_sign_changes(m):
    basis = cp.transformed(np.eye(m, dtype=np.int64)).T
    assert [(np.diff(row) != 0).sum() for row in basis] == list(range(m))
    x, y = np.random.default_rng(1).integers(-99, 99, (2, 1, m))
    assert ((cp.transformed(x) - cp.transformed(y)) ** 2).sum() == m * ((x - y) ** 2).sum()


def test_entries_are_given_up_early_and_ties_go_to_the_first(monkeypatch):
    r = np.random.default_rng(5)
    parts, entries = r.integers(-4, 5, (300, 5)), r.integers(-4, 5, (64, 5))
    entries[40:] = entries[:24]
    monkeypatch.setattr(cp, "PAIRS", 500)
    codes, distances = cp.nearest(parts, entries)
    whole = ((parts[:, None] - entries[None]) ** 2).sum(2)
    assert (codes == whole.argmin(1)).all() and (distances == whole.min(1)).all()
    assert cp.nearest(parts[:0], entries)[0].size == 0


def test_empty_table(spark, tmp_path):
    assert rows_of(cp.op12_vector_codes(spark, _write(tmp_path, []))) == []
    assert rows_of(cp.op12_vector_codes(spark, _write(tmp_path, [(1, None, 1), (2, [math.nan], 1)]))) == []


def test_hot_labels_are_summed_like_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cp.common, "HOT_KEYS", 2)
    rows = [(i, v, None if i % 2 else i % 5) for i, v, _ in _rows(120, 16)]
    assert sorted(rows_of(cp.op12_vector_codes(spark, _write(tmp_path, rows)))) == sorted(_brute(rows))
