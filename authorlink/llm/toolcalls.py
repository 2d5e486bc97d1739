"""Tool calls and their results: linked, put in order, checked and written as canonical JSON.

Calls and results meet in a join on conversation and identifier. A call comes after
the results of the calls that it needs: its place is its turn or, if that is later,
the place of what it needs, and ``depth`` orders calls with the same place. Needs that
point back, the usual case, are in order as they stand, so only calls that need
something from a later turn are moved, and only what is moved is looked at again. Calls
that need each other in a ring never settle; they are found when their depth passes the
number of calls that share their place. No step gathers a conversation in one task.

Arguments are checked against a schema for the tool (the keywords of ``CHECKS`` of JSON
Schema). Canonical JSON has sorted keys, no white space, and no needless escapes.

Defined cases. Of several calls, or results, with one identifier in a conversation the
first counts (lowest turn, then lowest content). Calls without result are
``unanswered``, results without call ``orphan``, calls in a ring ``cyclic``, other calls
``linked``. Rows without conversation or identifier are left out. Arguments that are not
JSON, null ones, and tools without schema are invalid; arguments that are not JSON stay
as text. Needs that name no call are ignored. Empty tables give empty results. Extra
columns are not carried along.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authorlink.llm import common

_KINDS = {
    "object": dict,
    "array": list,
    "string": str,
    "boolean": bool,
    "integer": int,
    "number": (int, float),
    "null": type(None),
}
CHECKS = ("type", "enum", "required", "properties", "additionalProperties", "items", "minimum", "maximum", "minLength", "maxLength")


def valid(value: object, schema: dict) -> bool:
    """Whether a value meets a schema's ``CHECKS``."""
    kind = schema.get("type")
    if kind and (not isinstance(value, _KINDS[kind]) or isinstance(value, bool) and kind in ("integer", "number")):
        return False
    if "enum" in schema and value not in schema["enum"]:
        return False
    if isinstance(value, dict):
        known = schema.get("properties", {})
        return (
            all(name in value for name in schema.get("required", ()))
            and (schema.get("additionalProperties", True) or set(value) <= set(known))
            and all(valid(value[name], of) for name, of in known.items() if name in value)
        )
    if isinstance(value, list):
        return all(valid(item, schema.get("items", {})) for item in value)
    if isinstance(value, str):
        return schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value))
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return schema.get("minimum", value) <= value <= schema.get("maximum", value)
    return True


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _once(rows: DataFrame, *columns: str) -> DataFrame:
    """The first row of each identifier; combined in every task before the shuffle."""
    usable = rows.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    first = usable.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", *columns)).alias("first"))
    return first.select("conv_id", "call_id", "first.*")


def ordered(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, place, depth, cyclic)`` of ``(conv_id, call_id, turn, needs)``, one row for each call."""
    node = ["conv_id", "call_id"]
    placed = calls.select(*node, F.col("turn").alias("place"), F.lit(0).alias("depth"), F.lit(False).alias("cyclic"))
    placed = common.written(placed, "places")
    edges = calls.select(*node, F.explode("needs").alias("need")).where("need IS NOT NULL").distinct()
    edges = common.written(edges, "needs")
    while True:
        sizes = placed.groupBy("conv_id", "place").agg(F.count(F.lit(1)).alias("_mates"))
        key = placed.select("conv_id", F.col("call_id").alias("need"), F.struct("place", (F.col("depth") + 1).alias("depth")).alias("least"))
        wanted = edges.join(key, ["conv_id", "need"]).groupBy(*node).agg(F.max("least").alias("least"))
        late = placed.where("NOT cyclic").join(wanted, node).where(F.struct("place", "depth") < F.col("least"))
        moved = late.select(*node, "least.place", "least.depth").join(sizes, ["conv_id", "place"], "left")
        moved = common.written(moved.withColumn("ring", F.col("depth") > F.coalesce("_mates", F.lit(0)) + 1), "moved")
        if moved.isEmpty():
            return placed
        new = moved.select(*node, F.col("place").alias("_p"), F.col("depth").alias("_d"), "ring")
        joined = placed.join(new, node, "left")
        placed = common.written(
            joined.select(
                *node,
                F.coalesce("_p", "place").alias("place"),
                F.coalesce("_d", "depth").alias("depth"),
                (F.col("cyclic") | F.coalesce("ring", F.lit(False))).alias("cyclic"),
            ),
            "places",
        )


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row for each call, and for each result without call, with its message in canonical JSON.

    ``calls``: ``(conv_id, turn, call_id, name, arguments, needs)`` with arguments as
    JSON and needs as an array of identifiers; ``results``: ``(conv_id, turn, call_id, content)``.
    """
    calls = common.written(_once(calls, "name", "arguments", "needs"), "calls")
    results = _once(results, "content").withColumnRenamed("turn", "result_turn")

    @F.pandas_udf("valid boolean, message string")
    def message(id_: pd.Series, name: pd.Series, arguments: pd.Series, content: pd.Series, is_call: pd.Series) -> pd.DataFrame:
        rows = []
        for i, n, a, c, call in zip(id_, name, arguments, content, is_call):
            if not call:
                rows.append((None, canonical({"id": i, "result": c})))
                continue
            try:
                value, parsed = json.loads(a), True
            except (TypeError, ValueError):
                value, parsed = a, False
            fits = parsed and n in schemas and valid(value, schemas[n])
            rows.append((fits, canonical({"arguments": value, "id": i, "name": n, "result": c})))
        return pd.DataFrame(rows, columns=["valid", "message"])

    node = ["conv_id", "call_id"]
    both = calls.drop("needs").join(ordered(calls), node).join(results, node, "full")
    is_call = F.col("place").isNotNull()
    status = (
        F.when(~is_call, "orphan").when(F.col("cyclic"), "cyclic").when(F.col("result_turn").isNull(), "unanswered").otherwise("linked")
    )
    told = both.withColumn("_told", message("call_id", "name", "arguments", "content", is_call))
    return told.select(
        *node,
        "name",
        F.coalesce("place", "result_turn").alias("place"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        status.alias("status"),
        "_told.valid",
        "_told.message",
    )


#: The tools as which user turns are taken, by turn, and what they accept.
TOOLS = ("lookup", "translate", "summarise")
_TEXT = {"type": "string", "minLength": 1, "maxLength": 380}
SCHEMAS = {
    "lookup": {
        "type": "object",
        "required": ["text", "words"],
        "properties": {"text": _TEXT, "words": {"type": "integer", "minimum": 2}},
        "additionalProperties": False,
    },
    "translate": {"type": "object", "required": ["text"], "properties": {"words": {"type": "integer", "maximum": 40}}},
    "summarise": {"type": "object", "required": ["text", "style"]},
}


def turns_as_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results made of turns: a user's turn is a call that needs the one two turns before, and the next turn is its result."""
    call_id = F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    asked = F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))
    before = F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), (F.col("turn") - 2).cast("string"))
    name = F.get(F.array(*map(F.lit, TOOLS)), F.pmod(F.floor(F.col("turn") / 2), F.lit(len(TOOLS))).cast("int"))
    arguments = F.to_json(F.struct(common.words_in(F.col("text")).alias("words"), common.text_or_empty().alias("text")))
    known = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    calls = known.where("role = 'user'").select(
        "conv_id", "turn", call_id.alias("call_id"), name.alias("name"), arguments.alias("arguments"), F.array(before).alias("needs")
    )
    results = known.where("role <> 'user'").select("conv_id", "turn", asked.alias("call_id"), common.text_or_empty().alias("content"))
    return calls, results


def op4_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = turns_as_calls(common.read(spark, sf_dir, "conversations"))
    return linked(calls, results, SCHEMAS)


OP4_SQL = r"""
WITH known AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
calls AS (
  SELECT conv_id, 'call-' || conv_id || '-' || turn AS call_id, min(turn) AS turn,
    ['lookup', 'translate', 'summarise'][1 + CAST(floor(min(turn) / 2) AS BIGINT) % 3] AS name, arg_min(text, to_json({words: len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), text: text})) AS text
  FROM known WHERE role = 'user' GROUP BY ALL),
results AS (
  SELECT conv_id, 'call-' || conv_id || '-' || (turn - 1) AS call_id, min(turn) AS result_turn, min(text) AS content
  FROM known WHERE role <> 'user' GROUP BY ALL),
both_ AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, name, text, turn, result_turn, content,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id)
SELECT conv_id, call_id, name, coalesce(turn, result_turn) AS place, 0 AS depth,
  CASE WHEN turn IS NULL THEN 'orphan' WHEN result_turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
  CASE WHEN name = 'lookup' THEN length(text) BETWEEN 1 AND 380 AND words >= 2
       WHEN name = 'translate' THEN words <= 40 WHEN name = 'summarise' THEN false END AS valid,
  CASE WHEN turn IS NULL THEN CAST(to_json({id: call_id, result: content}) AS VARCHAR)
       ELSE CAST(to_json({arguments: {text: text, words: words}, id: call_id, name: name, result: content}) AS VARCHAR) END AS message
FROM both_
"""
