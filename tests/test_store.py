"""The store of versions, and runs on a master in buckets."""

from __future__ import annotations

import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from authorlink import Inputs, MasterStore, Options, job, run_full_refresh, run_incremental
from authorlink import schemas as S
from authorlink.operators.delta import delta_classify, feed_credits
from authorlink.operators.keys import stacked
from authorlink.operators.load import mark_new_hashes, merge_upsert, overlay_changes
from authorlink.operators.matching import combine_linked
from authorlink.sources import workspace as workspaces
from authorlink.sources.buckets import WRITERS, buckets_for, buckets_of
from authorlink.sources.store import Release, StaleRelease
from authorlink.sources.workspace import Workspace
from authorlink.verify.fixtures import Fixtures
from authorlink.verify.steps import FullRefreshSteps, IncrementalSteps
from tests.conftest import SF_DIR
from tests.helpers import bag, credit, inputs, master_row, table


@pytest.fixture()
def store(spark, workspace):
    made = MasterStore(spark, f"{workspace.path}/store")
    yield made
    made.close()


@pytest.fixture()
def sorted_joins(spark):
    """Plans as they are for large tables."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def _rows(spark, n):
    return table(spark, S.MASTER, *[master_row(f"b{i}", i, i, order=i % 3, name=f"n{i}") for i in range(n)])


def test_versions_are_published_whole_and_kept(spark, store):
    assert store.current() is None and store.master().count() == 0 and store.stage() is None
    first = store.publish(_rows(spark, 40), buckets=4)
    assert (first.number, first.buckets, store.stage()) == (1, 4, None)
    old = store.master()
    assert buckets_of(old, S.MASTER_SLOT) == 4 and bag(old) == bag(_rows(spark, 40))
    second = store.publish(_rows(spark, 50), stage=_rows(spark, 7))
    assert [r.number for r in store.releases()] == [1, 2] and second.buckets == 4
    assert store.master().count() == 50 and store.stage().count() == 7
    assert old.count() == store.master(first).count() == 40


def test_a_run_that_was_overtaken_publishes_nothing(spark, store):
    first = store.publish(_rows(spark, 3), buckets=2)
    store.publish(_rows(spark, 4), after=first)
    with pytest.raises(StaleRelease):
        store.publish(_rows(spark, 5), stage=_rows(spark, 5), after=first)
    assert store.current().number == 2 and store.master().count() == 4 and store.stage() is None


def test_a_failure_between_master_and_stage_leaves_both_old(spark, store):
    store.publish(_rows(spark, 3), stage=_rows(spark, 2), buckets=2)
    broken = _rows(spark, 5).selectExpr("assert_true(indigo_author_id < 4) AS x", "*")
    with pytest.raises(Exception, match="assert_true|is not true"):
        store.publish(_rows(spark, 5), stage=broken)
    assert store.current().number == 1 and store.master().count() == 3 and store.stage().count() == 2
    assert store.publish(_rows(spark, 5)).number == 2


def test_a_release_is_plain_data():
    assert Release(**{"number": 1, "master": "m", "buckets": 2}) == Release(1, "m", 2, None)


def test_job_with_a_store(spark, workspace):
    made = inputs(spark, [credit(1, "b1", "A", 1, "Ann", "Bee")], (), [], [], [{"author_nm": "Ann Bee", "matched_isni": "I1"}])
    for name in Inputs.__dataclass_fields__:
        getattr(made, name).write.parquet(f"{workspace.path}/in/{name}")
    prior = {"isbn13": "b0", "trade_db_contributor_id": 5, "indigo_contr_id": 9, "indigo_contr_nm": "Old", "matched_isni": "I9", "author_nm": "Old", "ref_to": "ISNI"}
    table(spark, S.PRIOR_DELIVERY, {**prior, "contributor_role": "A", "contributor_order": 1}).write.parquet(f"{workspace.path}/prior")
    root = ["--store", f"{workspace.path}/store"]
    job.main(["bootstrap", "--folder", f"{workspace.path}/prior", "--buckets", "3", *root])
    job.main(["incremental", "--folder", f"{workspace.path}/in", *root])
    store = MasterStore(spark, root[1])
    assert [(r.number, r.buckets) for r in store.releases()] == [(1, 3), (2, 3)]
    assert bag(store.master(), "isbn13", "indigo_author_id", "matched_isni") == {("b0", 9, "I9"): 1, ("b1", 10, "I1"): 1}
    assert "etl_date_inserted" in store.stage().columns and store.stage().count() == 2
    store.close()
    with pytest.raises(SystemExit):
        job.main(["incremental", "--folder", "x", "--master-out", "y", *root])


# --- plans


def _moved(df):
    """The exchanges of a plan, each with what lies below it."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(re.match(r"([ :]*[+:]-)?", line).group()) for line in lines]
    out = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line or "Exchange SinglePartition" in line:
            end = next((k for k in range(i + 1, len(lines)) if depth[k] <= depth[i]), len(lines))
            out.append((line, "\n".join(lines[i + 1 : end])))
    return out


@pytest.fixture(scope="module")
def derived(spark, module_workspace):
    made = Fixtures(spark, SF_DIR).inputs(module_workspace)
    store = MasterStore(spark, f"{module_workspace.path}/store")
    store.publish(made.matched_author_isbn13, buckets=8)
    yield made, replace(made, matched_author_isbn13=store.master())
    store.close()


def test_a_master_in_buckets_is_not_moved_by_the_merge(spark, store, sorted_joins):
    store.publish(_rows(spark, 60), buckets=4)
    stage = _rows(spark, 90).drop("etl_updated_date")
    merged = merge_upsert(store.master(), stage)
    moved = _moved(merged)
    assert len(moved) == 1 and "Bucketed: true" not in moved[0][1]
    assert bag(merged, "isbn13") == bag(_rows(spark, 90), "isbn13")
    # What comes out lies in the same buckets, so publishing it moves nothing either.
    assert store.publish(merged).buckets == 4
    assert store.master().count() == 90


def test_an_incremental_run_moves_little(spark, workspace, derived, sorted_joins, monkeypatch):
    _, bucketed = derived
    plans = []
    stage, write_buckets = Workspace.stage, workspaces.write_buckets
    monkeypatch.setattr(Workspace, "stage", lambda self, df, name: (plans.append((name, _moved(df))), stage(self, df, name))[1])
    monkeypatch.setattr(
        workspaces, "write_buckets", lambda df, path, *args: (plans.append((path, _moved(df))), write_buckets(df, path, *args))[1]
    )
    result = run_incremental(bucketed, workspace)
    plans.append(("master", _moved(result.master)))
    # Beside the bitmap, which is of fixed size.
    moved = [(name, line, below) for name, found in plans for line, below in found if "hashpartitioning(_bucket" not in line]
    assert len(moved) <= 30, [(name, line) for name, line, _ in moved]
    of_master = [(name, line, below) for name, line, below in moved if "Bucketed: true" in below]
    for name, line, below in of_master:
        # What leaves the buckets is combined first, or rows without id, or hits of the bitmap.
        assert "Aggregate" in below.split("FileScan")[0] or name == "pending", (name, line)
    assert not any(name == "master" for name, _, _ in of_master)


@pytest.mark.parametrize("run", [run_incremental, run_full_refresh])
def test_buckets_do_not_change_results(spark, workspace, derived, run):
    plain, bucketed = derived
    one, other = run(plain, workspace), run(bucketed, workspace)
    for a, b in zip(one, other):
        a, b = a.drop("etl_updated_date"), b.drop("etl_updated_date")
        assert a.count() == b.count() and a.exceptAll(b).count() == 0


def _delivery(rng, books):
    people = [("Ann", "Bee"), ("Cy", "Dee"), ("Eve", "Foe"), (None, "Gee"), ("Unknown", None), (None, None)]
    rows = []
    for _ in range(60):
        k = rng.randrange(6)
        first, last = people[k] if rng.random() < 0.8 else rng.choice(people)
        rows.append(credit(rng.choice([k, k, None]), rng.choice([*books, None]), rng.choice(["A", "B", None]), rng.choice([1, 2, None]), first, last))
    return rows + rows[:5]


def test_deliveries_one_after_another_are_the_same_with_and_without_a_store(spark, workspace, store):
    rng = random.Random(11)
    authors = [{"isni": f"I{i}", "first_name": f, "last_name": n} for i, (f, n) in enumerate([("Ann", "Bee"), ("Cy", "Dee"), ("Cy", "Dee")])]
    engine = [{"author_nm": "Ann Bee", "matched_isni": "I0"}] + [{"author_nm": "Cy Dee", "matched_isni": f"I{i}", "dup_name_flag": "Y"} for i in (1, 2)]
    isbns = [{"isbn13": f"b{i}", "isni": f"I{1 + i % 2}"} for i in range(4)]
    plain = table(spark, S.MASTER, master_row("b0", 100, 9, name="Old Author", isni="I9", source="ISNI", hash_="h"), master_row(None, None, 1, isni="I0", name="Ann Bee"))
    store.publish(plain, buckets=3)
    options = Options(null_safe_keys=True, keep_placeholder_rows=True)
    for n, run in enumerate((run_incremental, run_incremental, run_full_refresh)):
        feed = _delivery(rng, [f"b{i}" for i in range(4 + n)])
        made = inputs(spark, feed, (), authors, isbns, engine)
        one = run(replace(made, matched_author_isbn13=plain), workspace, options)
        other = run(replace(made, matched_author_isbn13=store.master()), workspace, options)
        store.publish(other.master, other.stage)
        plain = workspace.stage(one.master, "plain")
        columns = [f.name for f in S.MASTER if f.name != "etl_updated_date"]
        assert bag(store.master(), *columns) == bag(plain, *columns)
        assert bag(store.stage()) == bag(one.stage)


def test_the_number_of_buckets_grows_with_the_rows(spark, workspace):
    assert buckets_for(0) == buckets_for(4_000_000) == 8 and buckets_for(108_000_000) == 216
    copy = workspace.in_buckets(_rows(spark, 40), "rows", S.MASTER_SLOT)
    assert buckets_of(copy, S.MASTER_SLOT) == 8 and bag(copy) == bag(_rows(spark, 40))
    assert workspace.in_buckets(copy, "rows", S.MASTER_SLOT) is copy


def test_a_run_without_a_store_moves_its_master_once(spark, workspace, derived, sorted_joins, monkeypatch):
    plain, _ = derived
    plans, stage, write_buckets = [], Workspace.stage, workspaces.write_buckets
    monkeypatch.setattr(Workspace, "stage", lambda self, df, name: (plans.append((name, _moved(df))), stage(self, df, name))[1])
    monkeypatch.setattr(
        workspaces, "write_buckets", lambda df, path, *args: (plans.append((path, _moved(df))), write_buckets(df, path, *args))[1]
    )
    run_incremental(plain, workspace)
    assert sum("/master-" in name for name, _ in plans) == 1
    assert len([line for _, found in plans for line, _ in found if "hashpartitioning(_bucket" not in line]) <= 30


def test_copies_leave_the_derived_master_before_names_are_made(spark):
    plan = Fixtures(spark, SF_DIR).matched_author_isbn13._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "HashAggregate" in line and "isbn13" in line]
    assert keys and not any("author_name" in line or "hash_id" in line for line in keys)
    assert "partial_" not in "".join(keys)


def test_a_stage_in_the_buckets_of_the_master_is_not_moved_by_the_merge(spark, workspace, sorted_joins):
    master = workspace.in_buckets(_rows(spark, 60), "master", S.MASTER_SLOT)
    stage = workspace.in_buckets(_rows(spark, 90).drop("etl_updated_date"), "stage", S.MASTER_SLOT)
    merged = merge_upsert(master, stage)
    assert _moved(merged) == [] and bag(merged, "isbn13") == bag(_rows(spark, 90), "isbn13")


def _by_joins(moved):
    """Without the asked-for dealing, which Spark leaves out while it runs where rows lie so already, and one-row aggregates."""
    return [line for line, _ in moved if "hashpartitioning" in line and "ENSURE_REQUIREMENTS" in line]


_WRITTEN_IN_PLACE = {
    IncrementalSteps: {"by_name", "residual_1", "residual_2", "combined_1", "by_contributor", "combined_3", "combined", "identified", "stage", "asked"},
    FullRefreshSteps: {"by_name", "residual_1", "residual_2", "combined_1", "by_contributor", "combined_3", "known", "allocated", "resolved", "asked"},
}


@pytest.mark.parametrize("kind", _WRITTEN_IN_PLACE)
def test_steps_leave_credits_in_the_buckets_they_were_dealt_to(spark, workspace, derived, kind, monkeypatch):
    plain, _ = derived
    plans, write_buckets = {}, workspaces.write_buckets

    def written(df, path, *args):
        plans[path.rsplit("/", 1)[1].rsplit("-", 1)[0]] = _moved(df)
        write_buckets(df, path, *args)

    monkeypatch.setattr(workspaces, "write_buckets", written)
    steps = kind(plain, workspace)
    steps.flagged
    # Few authors, contributors and names are met where the credits lie; only the master is dealt, and the feed.
    assert {name: plans[name] for name in _WRITTEN_IN_PLACE[kind] if _by_joins(plans[name])} == {}


def test_a_full_refresh_deals_credits_once(spark, workspace, derived, monkeypatch):
    _, bucketed = derived
    plans, write_buckets = {}, workspaces.write_buckets

    def written(df, path, *args):
        plans[path.rsplit("/", 1)[1].rsplit("-", 1)[0]] = _moved(df)
        write_buckets(df, path, *args)

    monkeypatch.setattr(workspaces, "write_buckets", written)
    run_full_refresh(bucketed, workspace)
    assert not any(_by_joins(plans[name]) for name in ("by_contributor", "known", "identified"))


def test_marking_hashes_leaves_a_stage_in_its_buckets(spark, workspace):
    master = workspace.in_buckets(_rows(spark, 60), "master", S.MASTER_SLOT)
    stage = workspace.in_buckets(_rows(spark, 90).drop("etl_updated_date"), "stage", S.MASTER_SLOT)
    marked = mark_new_hashes(stage, master, workspace)
    assert buckets_of(marked, S.MASTER_SLOT) == 8 and marked.count() == 90
    assert _moved(merge_upsert(master, marked, unseen="_unseen")) == []


def test_a_stack_of_tables_in_the_same_buckets_lies_in_them(spark, workspace):
    one = workspace.in_buckets(_rows(spark, 30), "one", S.MASTER_SLOT)
    both = stacked(one.filter("isbn13 IS NOT NULL").select("trade_db_author_name", *S.MASTER_SLOT), one.select("trade_db_author_name", *S.MASTER_SLOT))
    assert _moved(both.distinct()) == [] and both.count() == 60


def test_credits_and_changes_meet_a_master_in_buckets_without_sorting(spark, workspace, sorted_joins):
    master = workspace.in_buckets(_rows(spark, 60), "master", S.MASTER_SLOT)
    feed = table(spark, S.FEED, *[credit(i, f"b{i}", "A", i % 3, f"n{i + i // 50}", None) for i in range(40, 70)])
    classified = delta_classify(feed_credits(feed), master)
    changes = master.filter("trade_db_contributor_id < 7").select(
        *S.MASTER_SLOT, "trade_db_contributor_id", F.lit("new").alias("trade_db_author_name"), "matched_isni", "id_source"
    )
    changed = overlay_changes(master, changes)
    for rows in (classified, changed):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "Sort [" not in plan
    assert bag(classified, "delta_flag") == {("SAME",): 10, ("CHANGED",): 10, ("NEW",): 10}
    assert changed.filter("trade_db_author_name = 'new' AND indigo_author_id IS NULL").count() == 7 and changed.count() == 60


def test_writing_buckets_leaves_the_session_as_it_was(spark, workspace):
    before = spark.conf.get(WRITERS[0], None)
    kept = workspace.in_buckets(_rows(spark, 60), "master", S.MASTER_SLOT)
    assert spark.conf.get(WRITERS[0], None) == before and bag(kept) == bag(_rows(spark, 60))
    # Rows of all buckets in one task are more than its writers.
    mixed = workspace.stage_in_buckets(_rows(spark, 60).coalesce(1), "mixed", S.MASTER_SLOT, 8, dealt=True)
    assert bag(mixed) == bag(_rows(spark, 60)) and bag(mixed.join(kept, S.MASTER_SLOT, "left_semi")) == bag(kept)


def test_only_the_links_of_the_further_bucket_are_made_distinct(spark):
    link = {"trade_db_contributor_id": 1, "isbn13": "b", "contributor_role": "A", "contributor_order": 1, "author_nm": "n", "matched_isni": "i"}
    layout = "trade_db_contributor_id bigint, isbn13 string, contributor_role string, contributor_order bigint, author_nm string, matched_isni string, ref_to string"
    linked = table(spark, layout, {**link, "ref_to": S.BY_NAME})
    more = table(spark, layout, *[{**link, "ref_to": S.BY_CONTRIBUTOR}] * 3, {**link, "ref_to": None})
    both = combine_linked(linked, more)
    assert bag(both, "ref_to") == {(S.BY_NAME,): 1, (S.BY_CONTRIBUTOR,): 1}
    assert both._jdf.queryExecution().optimizedPlan().nodeName() == "Union"
