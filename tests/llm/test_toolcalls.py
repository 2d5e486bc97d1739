from __future__ import annotations

import json

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from authorlink.llm import toolcalls
from tests.llm.conftest import rows_of


def _calls(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>")


def _results(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, call_id string, content string")


def test_schema_checks():
    schema = {
        "type": "object",
        "required": ["n"],
        "additionalProperties": False,
        "properties": {"n": {"type": "integer", "minimum": 1, "maximum": 3}, "tags": {"type": "array", "items": {"type": "string", "minLength": 2}}, "kind": {"enum": ["a", None]}},
    }
    good = [{"n": 1}, {"n": 3, "tags": ["ab"], "kind": None}]
    bad = [[], {}, {"n": True}, {"n": 4}, {"n": 1.5}, {"n": 1, "x": 0}, {"n": 1, "tags": ["a"]}, {"n": 1, "kind": "b"}, None]
    assert all(toolcalls.valid(v, schema) for v in good)
    assert not any(toolcalls.valid(v, schema) for v in bad)


def test_linking_order_rings_and_orphans(spark):
    calls = _calls(
        spark,
        [
            (1, 0, "a", "f", '{"b":1, "a":"é\\n"}', ["c", "missing", None]),
            (1, 2, "b", "f", "{}", ["a"]),
            (1, 4, "c", "f", "not json", []),
            (1, 6, "d", "g", "{}", ["b", "c"]),
            (1, 6, "d", "g", "{}", ["zz"]),
            (2, 0, "x", "f", None, ["y"]),
            (2, 2, "y", "f", "{}", ["x"]),
            (3, 0, "s", "f", "{}", ["s"]),
            (None, 0, "n", "f", "{}", None),
            (4, 0, None, "f", "{}", None),
            (5, 0, "a", "f", "{}", None),
        ],
    )
    results = _results(spark, [(1, 1, "a", "late"), (1, 0, "a", "first"), (1, 7, "d", None), (9, 1, "a", "lost"), (2, 1, "x", "r")])
    out = {(r.conv_id, r.call_id): r for r in toolcalls.linked(calls, results, {"f": {"type": "object"}}).collect()}
    assert set(out) == {(1, "a"), (1, "b"), (1, "c"), (1, "d"), (2, "x"), (2, "y"), (3, "s"), (5, "a"), (9, "a")}
    place = {k: (r.place, r.depth) for k, r in out.items()}
    assert place[1, "c"] < place[1, "a"] < place[1, "b"] < place[1, "d"]
    assert {k: r.status for k, r in out.items() if r.status not in ("linked", "unanswered")} == {
        (2, "x"): "cyclic", (2, "y"): "cyclic", (3, "s"): "cyclic", (9, "a"): "orphan"}
    assert out[5, "a"].status == "unanswered" and out[1, "a"].status == "linked"
    assert out[1, "a"].message == '{"arguments":{"a":"é\\n","b":1},"id":"a","name":"f","result":"first"}'
    assert (out[1, "a"].valid, out[1, "c"].valid, out[1, "d"].valid, out[9, "a"].valid) == (True, False, False, None)
    assert json.loads(out[1, "c"].message)["arguments"] == "not json"


def test_empty_tables(spark):
    assert toolcalls.linked(_calls(spark, []), _results(spark, []), {}).count() == 0


def test_query_against_sql(spark, tmp_path):
    rows = [
        (1, 0, "user", 'say "hi" \\ \n'),
        (1, 1, "assistant", "ok\tdone"),
        (1, 2, "user", None),
        (1, 2, "user", None),
        (1, 4, "user", "z"),
        (1, 4, "user", "b c"),
        (2, 0, "system", "rules"),
        (2, 1, "user", "x " * 300),
        (2, 2, "assistant", "y"),
        (2, 2, "tool", "a"),
        (None, 0, "user", "q"),
        (3, None, "user", "q"),
        (4, 0, None, "q"),
    ]
    table = pa.table({n: pa.array(c, k) for n, c, k in zip(("conv_id", "turn", "role", "text"), zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string()))})
    pq.write_table(table, tmp_path / "conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet')")
    want = con.execute(toolcalls.OP4_SQL).fetchall()
    assert sorted(rows_of(toolcalls.op4_tool_call_linking(spark, str(tmp_path))), key=repr) == sorted(want, key=repr)
