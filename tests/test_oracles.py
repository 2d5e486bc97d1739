"""Every operator and both runs against independent SQL, on the derived tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from authorlink.verify.fixtures import Fixtures
from authorlink.verify.oracles import oracle_sql
from authorlink.verify.queries import FULL_STEPS, INCREMENTAL_STEPS, queries
from authorlink.verify.steps import FullRefreshSteps, IncrementalSteps
from tests.conftest import SF_DIR

_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}
_STEP_KEYS = {**FULL_STEPS, **INCREMENTAL_STEPS}
_ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


@pytest.fixture(scope="module")
def steps(spark, module_workspace):
    inputs = Fixtures(spark, SF_DIR).inputs(module_workspace)
    return {
        **dict.fromkeys(FULL_STEPS, FullRefreshSteps(inputs, module_workspace)),
        **dict.fromkeys(INCREMENTAL_STEPS, IncrementalSteps(inputs, module_workspace)),
    }


def _compare(duck, result, sql):
    types = {f.name: _TYPES[f.dataType.simpleString()] for f in result.schema}
    ours = result.toArrow()
    duck.execute("CREATE OR REPLACE TEMP TABLE mine AS SELECT * FROM ours")
    duck.execute(f"CREATE OR REPLACE TEMP TABLE theirs AS {sql}")
    assert {r[0]: r[1] for r in duck.execute("DESCRIBE theirs").fetchall()} == types
    columns = ", ".join(types)
    for one, other in (("mine", "theirs"), ("theirs", "mine")):
        extra = f"SELECT {columns} FROM {one} EXCEPT ALL SELECT {columns} FROM {other}"
        assert duck.execute(f"SELECT count(*) FROM ({extra})").fetchone() == (0,)
    return ours.num_rows


def test_every_query_has_an_oracle():
    assert set(queries()) == set(_ORACLES)


@pytest.mark.parametrize("key", sorted(_STEP_KEYS))
def test_operator(duck, steps, key):
    result = getattr(steps[key], _STEP_KEYS[key]).drop("etl_updated_date")
    assert _compare(duck, result, _ORACLES[key]) > 0


@pytest.mark.parametrize("key", sorted(set(queries()) - set(_STEP_KEYS)))
def test_query(spark, duck, key):
    assert _compare(duck, queries()[key](spark, SF_DIR), _ORACLES[key]) > 0


def test_delta_counts_of_the_derived_tables(steps):
    if not SF_DIR.endswith("sf0.01"):
        pytest.skip("counts are known for one scale")
    rows = steps["p06_delta_classify"].classified.groupBy("delta_flag").count().collect()
    assert {r[0]: r[1] for r in rows} == {"NEW": 30040, "CHANGED": 4512, "SAME": 25448}
