"""Whole runs on small tables, over two deliveries, and under forced skew handling."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest

from authorlink import Inputs, Options, job, prepare_matching, run_bootstrap, run_full_refresh, run_incremental
from authorlink import schemas as S
from authorlink.sources import tables
from authorlink.sources.workspace import Workspace
from authorlink.verify.fixtures import Fixtures
from tests.conftest import SF_DIR
from tests.helpers import bag, credit, inputs, master_row

_FEED = [
    credit(1, "b1", "A", 1, "Ann", "Bee"),  # unique name
    credit(2, "b1", "A", 2, "Cy", "Dee"),  # ambiguous name, confirmed by the book
    credit(1, "b2", "A", 1, "A.", "Bee"),  # known through the contributor
    credit(3, "b2", "A", 2, "Eve", "Foe"),  # no evidence
    credit(4, "b2", "A", 3, None, None),  # no name
]
_AUTHORS = [
    {"isni": "I1", "first_name": "Ann", "last_name": "Bee"},
    {"isni": "I2", "first_name": "Cy", "last_name": "Dee"},
    {"isni": "I3", "first_name": "Cy", "last_name": "Dee"},
]
_ISBNS = [{"isbn13": "b1", "isni": "I2"}]
_ENGINE = [
    {"author_nm": "Ann Bee", "matched_isni": "I1"},
    {"author_nm": "Cy Dee", "matched_isni": "I2", "dup_name_flag": "Y"},
    {"author_nm": "Cy Dee", "matched_isni": "I3", "dup_name_flag": "Y"},
]
_OLD = [master_row("b0", 100, 9, name="Old Author", isni="I9", source="ISNI", hash_="h")]
_COLUMNS = ("isbn13", "trade_db_contributor_id", "indigo_author_id", "matched_isni", "id_source", "dmc_synced")


def _tables(spark, feed=_FEED, master=_OLD):
    return inputs(spark, feed, master, _AUTHORS, _ISBNS, _ENGINE)


def _next(result, before, workspace):
    """The inputs of the following run, with the new master written."""
    master = workspace.stage(result.master, "next")
    return Inputs(**{**before.__dict__, "matched_author_isbn13": master})


def test_incremental(spark, workspace):
    result = run_incremental(_tables(spark), workspace)
    # The whole master is staged again, and the hash of its old row was not the hash of its values.
    assert bag(result.master, *_COLUMNS) == {
        ("b0", 9, 100, "I9", "ISNI", False): 1,
        ("b1", 1, 101, "I1", "ISNI", False): 1,
        ("b1", 2, 102, "I2", "ISNI&PREFILLISNI", False): 1,
        ("b2", 1, 101, "I1", "TRADEDBID&ISNI", False): 1,
    }
    # Both names of contributor 1 occur once; the longer one is canonical.
    names = {r["indigo_author_id"]: r["normailized_author_name"] for r in result.master.collect()}
    assert names[101] == "Ann Bee"


def test_full_refresh(spark, workspace):
    result = run_full_refresh(_tables(spark), workspace)
    assert bag(result.master, *_COLUMNS) == {
        ("b0", 9, 100, "I9", "ISNI", True): 1,
        ("b1", 1, 101, "I1", "ISNI", False): 1,
        ("b1", 2, 102, "I2", "ISNI&PREFILLISNI", False): 1,
        ("b2", 1, 101, "I1", "TRADEDBID&ISNI", False): 1,
        ("b2", 3, 103, None, "TRADEDBID", False): 1,
    }


def test_second_full_refresh_finds_nothing_new(spark, workspace):
    first = _tables(spark)
    second = _next(run_full_refresh(first, workspace), first, workspace)
    result = run_full_refresh(second, workspace)
    assert result.stage.count() == 0
    assert bag(result.master) == bag(second.matched_author_isbn13)


def test_second_incremental_run_repeats_only_credits_without_isni(spark, workspace):
    first = _tables(spark)
    second = _next(run_incremental(first, workspace), first, workspace)
    before = bag(second.matched_author_isbn13, *_COLUMNS[:-1])
    result = run_incremental(second, workspace)
    assert bag(result.master, *_COLUMNS[:-1]) == before


def test_credits_without_isni_can_be_kept(spark, workspace):
    result = run_incremental(_tables(spark), workspace, Options(keep_placeholder_rows=True))
    assert bag(result.master, *_COLUMNS)[("b2", 3, 103, None, "TRADEDBID", False)] == 1


def test_changed_credit_with_a_new_isni_stays_beside_its_successor(spark, workspace):
    master = _OLD + [master_row("b1", 50, 1, name="Anna", isni="I5", source="ISNI", hash_="x")]
    result = run_incremental(_tables(spark, feed=_FEED[:1], master=master), workspace)
    assert bag(result.master, "isbn13", "indigo_author_id", "matched_isni", "dmc_sync_hash_id") != {}
    rows = [(r["indigo_author_id"], r["matched_isni"], r["dmc_synced"]) for r in result.master.filter("isbn13 = 'b1'").collect()]
    assert sorted(rows, key=str) == [(101, "I1", False), (None, "I1", True)]


def test_first_run_needs_an_id_to_start_from(spark, workspace):
    empty = _tables(spark, master=())
    assert run_incremental(empty, workspace).master.count() == 0
    assert run_full_refresh(empty, workspace).master.count() == 0
    floored = run_incremental(empty, workspace, Options(id_floor=0)).master
    # The placeholder of the third contributor takes a number too, after all real ISNIs.
    assert {r["indigo_author_id"] for r in floored.collect()} == {1, 2}
    assert {r["indigo_author_id"] for r in run_full_refresh(empty, workspace, Options(id_floor=0)).master.collect()} == {1, 2, 3}


def test_missing_key_parts(spark, workspace):
    gap = credit(1, "b3", None, 1, "Ann", "Bee")  # linked by name, without a role
    tables_ = _tables(spark, feed=[*_FEED, gap])
    result = run_incremental(tables_, workspace)
    # Its key is NULL, and nothing is NOT IN a set with a NULL: later buckets stay empty.
    assert set(bag(result.stage, "id_source")) == {("ISNI",)}
    safe = run_incremental(tables_, workspace, Options(null_safe_keys=True))
    assert set(bag(safe.stage, "id_source")) == {("ISNI",), ("ISNI&PREFILLISNI",), ("TRADEDBID&ISNI",)}


@pytest.fixture(scope="module")
def derived(spark, module_workspace):
    return Fixtures(spark, SF_DIR).inputs(module_workspace)


@pytest.mark.parametrize("settings", [{"adaptive.enabled": "false"}, {"adaptive.coalescePartitions.enabled": "false"}])
@pytest.mark.parametrize("run", [run_incremental, run_full_refresh])
def test_runs_do_not_depend_on_adaptive_plans(spark, workspace, derived, run, settings):
    plain = run(derived, workspace)
    counts = [part.count() for part in plain]
    for name, value in settings.items():
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        other = run(derived, workspace)
        for one, part, n in zip(plain, other, counts):
            a, b = one.drop("etl_updated_date"), part.drop("etl_updated_date")
            assert part.count() == n and a.exceptAll(b).count() == 0
    finally:
        for name in settings:
            spark.conf.unset(f"spark.sql.{name}")


@pytest.mark.parametrize(("run", "incremental"), [(run_incremental, True), (run_full_refresh, False)])
def test_prepare_then_match_then_run(spark, workspace, derived, run, incremental):
    unmatched = replace(derived, engine_output=derived.engine_output.limit(0))
    made = prepare_matching(unmatched, workspace, incremental)
    names = {r["author_nm"] for r in made.names.collect()}
    assert {r["author_nm"] for r in derived.engine_output.collect()} & names
    assert made.holders.count() == derived.isni_authors.distinct().count()
    one = run(derived, workspace).master.drop("etl_updated_date")
    other = run(derived, workspace, work=made.work).master.drop("etl_updated_date")
    assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_no_step_gathers_rows_in_one_partition(spark, workspace, monkeypatch):
    plans = []
    stage = Workspace.stage
    monkeypatch.setattr(
        Workspace,
        "stage",
        lambda self, df, name: (plans.append((name, df._jdf.queryExecution().executedPlan().toString())), stage(self, df, name))[1],
    )
    result = run_incremental(_tables(spark), workspace)
    plans.append(("master", result.master._jdf.queryExecution().executedPlan().toString()))
    for _, plan in plans:
        lines = plan.splitlines()
        assert "CartesianProduct" not in plan
        for line, child in zip(lines, lines[1:]):
            # Only an aggregate to one row may end in one partition, and it is partly done before.
            if "Exchange SinglePartition" in line:
                assert "Aggregate(key" in child and "partial_" in child
        for line in lines:
            # Joins without a key only ever bring in one row, or one row per partition.
            assert "NestedLoopJoin" not in line or "BuildRight, Cross" in line or "BuildRight, Inner" in line


# --- sources and sinks


def test_inputs_from_folder_and_catalog(spark, workspace):
    made = _tables(spark)
    for name in Inputs.__dataclass_fields__:
        getattr(made, name).write.parquet(f"{workspace.path}/in/{name}")
    read = Inputs.from_folder(spark, f"{workspace.path}/in")
    assert bag(read.trade_contributors) == bag(made.trade_contributors)
    assert read.matched_author_isbn13.schema == S.MASTER


def test_job(spark, workspace):
    for name in Inputs.__dataclass_fields__:
        getattr(_tables(spark), name).write.parquet(f"{workspace.path}/in/{name}")
    out = [f"{workspace.path}/{name}" for name in ("v1", "stage", "v0")]
    job.main(["incremental", "--folder", f"{workspace.path}/in", "--master-out", out[0], "--stage-out", out[1]])
    assert spark.read.parquet(out[0]).count() == spark.read.parquet(out[1]).count() == 4
    prior = Fixtures(spark, SF_DIR.replace("sf0.01", "sf0.001")).book_ref_prior
    prior.write.parquet(f"{workspace.path}/prior")
    job.main(["bootstrap", "--folder", f"{workspace.path}/prior", "--master-out", out[2]])
    assert spark.read.parquet(out[2]).count() > 0


def test_snapshots_are_never_overwritten(spark, workspace):
    made = _tables(spark)
    path = f"{workspace.path}/v1"
    tables.write_snapshot(made.matched_author_isbn13, path)
    with pytest.raises(Exception, match="(?i)exist"):
        tables.write_snapshot(made.matched_author_isbn13, path)
    assert bag(tables.publish_stage(made.isni_isbns, path)) == bag(made.isni_isbns)


def test_job_prepares_and_leaves_nothing_behind_when_it_fails(spark, workspace, monkeypatch):
    made, folder = _tables(spark), f"{workspace.path}/in2"
    for name in Inputs.__dataclass_fields__:
        if name != "engine_output":
            getattr(made, name).write.parquet(f"{folder}/{name}")
    job.main(["prepare", "--folder", folder, "--out", f"{folder}-match"])
    assert {r["author_nm"] for r in spark.read.parquet(f"{folder}-match/names").collect()} == {"Ann Bee", "A. Bee", "Cy Dee", "Eve Foe"}
    opened = []

    class Watched(Workspace):
        def __init__(self, spark):
            super().__init__(spark)
            opened.append(self.path)

    monkeypatch.setattr(job, "Workspace", Watched)
    made.engine_output.write.parquet(f"{folder}/engine_output")
    run = ["incremental", "--folder", folder, "--work", f"{folder}-match/work", "--stage-out", f"{folder}-stage"]
    os.makedirs(f"{folder}-taken")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        job.main([*run, "--master-out", f"{folder}-taken"])
    assert opened and not any(os.path.exists(path) for path in opened) and not os.path.exists(f"{folder}-stage")
    job.main([*run, "--master-out", f"{folder}-v2", "--run-ts", "2026-01-25", "--audit", "run_id=r1"])
    stage = spark.read.parquet(f"{folder}-stage")
    assert set(bag(stage, "run_id")) == {("r1",)} and stage.filter("etl_date_inserted = '2026-01-25'").count() == stage.count() > 0


def test_audit_columns_and_stage_path(spark, workspace):
    options = Options(audit={"pipeline_run_id": "run-1"}, transformation_id=7)
    for run in (run_incremental, run_full_refresh):
        path = f"{workspace.path}/{run.__name__}"
        stage = run(_tables(spark), workspace, options, path).stage
        assert set(bag(stage, "pipeline_run_id", "transformation_id")) == {("run-1", 7)}
        assert spark.read.parquet(path).count() == stage.count()


def test_workspace_needs_a_shared_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        Workspace(Session())


def test_bootstrap_feeds_a_run(spark, workspace):
    prior = Fixtures(spark, SF_DIR.replace("sf0.01", "sf0.001")).book_ref_prior
    master = run_bootstrap(prior)
    assert master.dtypes == [(f.name, f.dataType.simpleString()) for f in S.MASTER]
    result = run_incremental(Inputs(**{**_tables(spark).__dict__, "matched_author_isbn13": master}), workspace)
    assert result.master.count() > 0
