from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import random
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from authorlink.llm import warc
from tests.llm.conftest import rows_of

_DATE = "2020-01-02T03:04:05Z"


def _table(rows):
    columns = [pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else ([], [], []), (pa.int64(), pa.string(), pa.string()))]
    return pa.table(columns, ["page_id", "url", "html"])


def _write(path, rows):
    table = _table(rows)
    for name in ("digest", "payload", "n", "value"):
        table = table.append_column(name, pa.array(["x"] * len(rows), pa.string()))
    pq.write_table(table, path / "pages.parquet")
    return str(path)


def _digest(body):
    return base64.b32encode(hashlib.sha1(body).digest()).decode()


def _brute(rows, least=0):
    groups = {}
    for i, url, html in rows:
        groups.setdefault((html or "").encode(), []).append((i is None, i, url is None, url or ""))
    out = []
    for body, of in groups.items():
        of.sort(key=lambda r: (r[0], r[1] or 0, r[2], r[3]))
        for k, (_, i, _, _) in enumerate(of):
            first = k == 0 or len(body) < least
            out.append((i, len(body), _digest(body), "response" if first else "revisit", None if first else of[0][1]))
    return Counter(out)


def _pages():
    r = random.Random(4)
    tricky = ["", None, "\r\n\r\n", "\n", "\r", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n", "WARC/1.1\r\n", "é 東京 🎉\x00\x7f", "x" * 300_000 + "\n" * 5000]
    bodies = tricky + ["".join(r.choice("ab\r\n") for _ in range(r.randrange(60))) for _ in range(80)]
    rows = [(i, f"http://h{i % 7}.example/{i}", b) for i, b in enumerate(bodies)]
    rows += [(1000 + i, f"http://mirror.example/{i}", r.choice(bodies)) for i in range(150)]
    rows += [(5, "http://a.example/\r\nX-Bad: 1", "tail"), (5, None, "tail"), (None, "http://n.example", "tail"), (None, None, None), (5, None, "tail"), (7, "u", "only"), (7, "u", "only")]
    return rows


def test_query_against_brute_force_and_sql(spark, tmp_path):
    rows = _pages()
    assert Counter(rows_of(warc.op13_warc_revisits(spark, _write(tmp_path, rows)))) == _brute(rows)
    rows = [r for r in rows if r[0] is not None]
    sf = _write(tmp_path, rows)
    got = Counter(rows_of(warc.op13_warc_revisits(spark, sf)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    assert Counter(con.execute(warc.OP13_SQL).fetchall()) == got == _brute(rows)


def test_archives_are_warc_and_payloads_come_back(spark, tmp_path):
    rows = [r for r in _pages() if r[0] is not None and r[0] != 5 and r[0] != 7]
    folder = str(tmp_path / "archives")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), folder, date=_DATE)
    text = b"".join(gzip.open(f).read() for f in sorted(glob.glob(f"{folder}/*.gz")))
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.endswith(b"\r\n\r\n")
    records = [r.asDict() for r in warc.read(spark, folder).collect()]
    assert len({r["record_id"] for r in records}) == len(records) == len(rows)
    assert {r["date"] for r in records} == {_DATE}
    by_id = {r["record_id"]: r for r in records}
    bodies = {i: (html or "").encode() for i, _, html in rows}
    for r in records:
        whole = by_id[r["refers_to"]] if r["record_type"] == "revisit" else r
        assert bytes(whole["payload"]) == bodies[r["page_id"]] and r["digest"] == _digest(bodies[r["page_id"]])
        if r["record_type"] == "revisit":
            assert r["payload"] is None and r["refers_to_uri"] == whole["uri"] and r["refers_to_date"] == _DATE


@pytest.mark.parametrize("bits", [1 << 24, 1 << 15])
def test_the_bitmap_changes_nothing(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(warc, "BITS", bits)
    rows = [(i, f"u{i}", f"body {i % 30 if i < 60 else i}") for i in range(400)]
    folder = str(tmp_path / "archives")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6), folder)
    assert Counter(rows_of(warc.resolved(warc.read(spark, folder, payloads=False)))) == _brute(rows)


def test_short_payloads_stay_responses(spark, tmp_path):
    rows = [(i, f"u{i}", "ab" if i % 2 else "abcdef") for i in range(10)]
    folder = str(tmp_path / "archives")
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), folder, least=5)
    assert Counter(rows_of(warc.resolved(warc.read(spark, folder)))) == _brute(rows, least=5)


def test_archives_with_and_without_revisits_are_deduplicated_alike(spark, tmp_path):
    rows = [r for r in _pages() if r[0] is not None]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folders = [str(tmp_path / f"archives-{i}") for i in range(5)]
    warc.write(pages, folders[0], least=1 << 40)
    assert {r[3] for r in rows_of(warc.resolved(warc.read(spark, folders[0])))} == {"response"}
    warc.deduplicated(spark, folders[0], folders[1])
    warc.deduplicated(spark, folders[1], folders[2])
    for folder in folders[1:3]:
        assert Counter(rows_of(warc.resolved(warc.read(spark, folder)))) == _brute(rows)


def test_bytes_that_are_no_text_and_revisits_without_original(spark, tmp_path):
    body = bytes(range(256)) * 3
    rows = [(1, "u", body, _digest(body), len(body)), (2, "v", None, _digest(body), len(body)), (3, "w", None, "A" * 32, 9)]
    df = spark.createDataFrame(rows, "page_id long, uri string, payload binary, digest string, payload_bytes long")
    folders = [str(tmp_path / f"archives-{i}") for i in range(2)]
    warc.write_captures(df, folders[0])
    warc.deduplicated(spark, folders[0], folders[1])
    want = [(1, len(body), _digest(body), "response", None), (2, len(body), _digest(body), "revisit", 1), (3, None, "A" * 32, "revisit", None)]
    for folder in folders:
        records = warc.read(spark, folder)
        assert sorted(rows_of(warc.resolved(records))) == want
        assert [bytes(r[0]) for r in rows_of(records.where("page_id = 1").select("payload"))] == [body]


def test_hot_payload(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc.common, "HOT_KEYS", 3)
    rows = [(i, f"u{i}", "hot" if i % 3 else f"body {i // 9}") for i in range(200)]
    assert Counter(rows_of(warc.op13_warc_revisits(spark, _write(tmp_path, rows)))) == _brute(rows)


def test_empty_table(spark, tmp_path):
    assert rows_of(warc.op13_warc_revisits(spark, _write(tmp_path, []))) == []
