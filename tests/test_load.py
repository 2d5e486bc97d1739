from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from authorlink import schemas as S
from authorlink.functions.hashing import change_hash
from authorlink.operators import bitmap, canonical, ids, load, matching
from authorlink.options import Options
from tests.helpers import bag, master_row, table

_LINK_DDL = (
    "trade_db_contributor_id bigint, isbn13 string, contributor_role string, contributor_order bigint, "
    "author_nm string, delta_flag string, matched_isni string, ref_to string"
)


def _linked(spark, *rows):
    names = ["trade_db_contributor_id", "isbn13", "contributor_role", "contributor_order", "author_nm"]
    names += ["delta_flag", "matched_isni", "ref_to"]
    return table(spark, _LINK_DDL, *[dict(zip(names, r)) for r in rows])


def _stage(spark, *rows):
    return table(spark, S.MASTER, *rows).select(*load.STAGED)


# --- changed credits


def test_lowest_changed_credit_wins_its_slot(spark):
    master = table(
        spark,
        S.MASTER,
        master_row("b", 10, 1, name="Old", isni="I1", source="ISNI", hash_="h"),
        master_row("b", 11, 2, name="Same slot"),
        master_row("b", 12, 3, order=2, name="Other slot"),
        master_row("b", 13, 4, order=None, name="No slot"),
    )
    linked = _linked(
        spark,
        (7, "b", "A", 1, "Seven", "CHANGED", "I7", "ISNI"),
        (5, "b", "A", 1, "Five", "CHANGED", "I5", "ISNI"),
        (4, "b", "A", 1, "New one", "NEW", "I4", "ISNI"),
        (4, "b", "A", None, "No slot", "CHANGED", "I4", "ISNI"),
    )
    found = load.apply_changed(master, linked)
    columns = ("trade_db_contributor_id", "indigo_author_id", "trade_db_author_name", "matched_isni", "dmc_sync_hash_id")
    assert bag(found, *columns) == {
        (5, None, "Five", "I5", "h"): 1,
        (5, None, "Five", "I5", None): 1,
        (3, 12, "Other slot", None, None): 1,
        (4, 13, "No slot", None, None): 1,
    }


# --- ids and names


def test_master_backfill_takes_both_maxima(spark):
    master = table(
        spark,
        S.MASTER,
        master_row("b", 1, 1, isni="I", canonical="Z", name="n"),
        master_row("b", 2, 2, isni="I", canonical="A", name="n"),
        master_row("b", None, 3, isni="I", name="mine"),
        master_row("b", None, 4, isni="J", name="alone"),
        master_row("b", None, 5, name="none"),
    )
    found = ids.backfill_master_ids(master)
    assert bag(found, "trade_db_contributor_id", "indigo_author_id", "normailized_author_name") == {
        (1, 1, "Z"): 1,
        (2, 2, "A"): 1,
        (3, 2, "Z"): 1,
        (4, None, "alone"): 1,
        (5, None, "none"): 1,
    }


def test_stage_backfill_prefers_an_id_over_none(spark):
    master = table(
        spark, S.MASTER, master_row("b", None, 1, isni="I"), master_row("b", 9, 1, isni="I"), master_row("c", 4, 8)
    )
    stage = table(
        spark, S.MASTER, master_row("x", None, 1, isni="I"), master_row("x", None, 8, isni="trdb8"), master_row("x", None, 2, isni="J")
    )
    found = ids.backfill_stage_ids_full(stage, master)
    assert bag(found, "matched_isni", "indigo_author_id") == {("I", 9): 1, ("trdb8", 4): 1, ("J", None): 1}


def test_new_ids_follow_the_highest_in_use(spark, workspace):
    rows = spark.createDataFrame(
        [("C", None), ("A", None), ("A", None), ("B", 50), (None, None)], "matched_isni string, i bigint"
    )
    master = table(spark, S.MASTER, master_row("b", 70, 1))
    found = ids.allocate_ids(rows, master, workspace, "i")
    assert bag(found, "matched_isni", "i") == {("A", 71): 2, ("B", 50): 1, ("C", 72): 1, (None, None): 1}
    empty = rows.filter("i IS NULL")
    assert {r["i"] for r in ids.allocate_ids(empty, None, workspace, "i").collect()} == {None}
    floored = ids.allocate_ids(empty, None, workspace, "i", id_floor=0)
    assert bag(floored, "matched_isni", "i") == {("A", 1): 2, ("C", 2): 1, (None, None): 1}


def test_canonical_name_by_frequency_length_alphabet(spark):
    rows = spark.createDataFrame(
        [(1, "Ann B"), (1, "Ann B"), (1, "Anne B"), (1, "Anne B"), (2, "b"), (2, "a"), (3, "x"), (3, "x"), (3, "long"), (None, "n"), (4, None)],
        "i bigint, author_nm string",
    )
    names = canonical.canonical_names(rows, "i", "author_nm")
    assert bag(names, "i", "_canonical") == {(1, "Anne B"): 1, (2, "a"): 1, (3, "x"): 1}
    assert canonical.add_canonical_name(rows, names, "i", "c").filter("c IS NULL").count() == 2


def test_placeholder_names_lose_their_identity(spark):
    rows = spark.createDataFrame(
        [("Anonymous", "I", "ISNI", 1), ("Ann", "I", "ISNI", 1), (" UNKNOWN", "I", "ISNI", 1), (None, "I", "ISNI", 1)],
        "author_nm string, matched_isni string, ref_to string, indigo_contr_id bigint",
    )
    found = canonical.null_placeholder_names(rows)
    assert {r[0] for r in found.filter("indigo_contr_id IS NULL").collect()} == {"Anonymous"}


def test_unique_isni_per_contributor(spark):
    pairs = spark.createDataFrame(
        [(1, "I"), (1, "I"), (2, "I"), (2, "J"), (3, None), (4, "K"), (4, None)],
        "trade_db_contributor_id bigint, matched_isni string",
    )
    assert bag(matching.unique_isni_per_contributor(pairs), "trade_db_contributor_id", "matched_isni") == {(1, "I"): 1, (4, "K"): 1}


def test_hash_tells_missing_from_moved_values(spark):
    df = spark.createDataFrame([(1, 2, None, "a"), (1, 2, "a", None), (1, 2, "\\N", "a")], "c long, i long, n string, s string")
    hashes = [r[0] for r in df.select(change_hash(*[F.col(c) for c in df.columns])).collect()]
    assert hashes[0] != hashes[1]


# --- merging


def _merge_tables(spark):
    master = table(
        spark,
        S.MASTER,
        master_row("b", 1, 1, name="Old", hash_="h1"),
        master_row("b", 1, 1, name="Copy", hash_="h2"),
        master_row("b", 2, 2, name="Alone", hash_="h3"),
        master_row("b", None, 3, name="No id", hash_="h4"),
    )
    stage = _stage(
        spark,
        master_row("b", 1, 1, name="B", hash_="h5"),
        master_row("b", 1, 1, name="A", hash_="h6"),
        master_row("c", 3, 3, name="Fresh", hash_="h7"),
        master_row("b", 5, 3, order=None, name="No order", hash_="h3"),
        master_row("b", 5, 3, order=None, name="No order 2", hash_="h3"),
    )
    return master, stage


_EXPECTED_MERGE = {
    ("b", 1, "A", "h6", True): 2,
    ("b", 2, "Alone", "h3", True): 1,
    ("b", None, "No id", "h4", True): 1,
    ("c", 3, "Fresh", "h7", None): 1,
    ("b", 5, "No order", "h3", None): 1,
    ("b", 5, "No order 2", "h3", None): 1,
}
_MERGE_COLUMNS = ("isbn13", "indigo_author_id", "trade_db_author_name", "dmc_sync_hash_id", "dmc_synced")


_PLANS = {
    "coalescing": {},
    "uncoalesced": {"spark.sql.adaptive.coalescePartitions.enabled": "false"},
    "fixed": {"spark.sql.adaptive.enabled": "false"},
    "sorted": {"spark.sql.autoBroadcastJoinThreshold": "-1"},
}


@pytest.fixture(params=_PLANS)
def plans(spark, request):
    old = {name: spark.conf.get(name, None) for name in _PLANS[request.param]}
    for name, value in _PLANS[request.param].items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_merge(spark, plans):
    master, stage = _merge_tables(spark)
    found = load.merge_upsert(master, stage)
    # A missing key part never meets anything, so such rows are not even compared with each other.
    assert bag(found, *_MERGE_COLUMNS) == _EXPECTED_MERGE
    stamped = found.filter("etl_updated_date IS NOT NULL")
    assert set(bag(stamped, "trade_db_author_name")) == {("A",)}
    assert load.merge_upsert(master.limit(0), stage).count() == 4
    assert load.merge_upsert(master, stage.limit(0)).count() == 4


def test_merge_strict(spark):
    master, stage = _merge_tables(spark)
    strict = Options(strict_merge=True)
    with pytest.raises(Exception, match="several staged rows"):
        load.merge_upsert(master, stage, strict).collect()
    single = stage.filter("trade_db_author_name <> 'B'")
    assert load.merge_upsert(master, single, strict).count() == 7


def test_merge_null_safe(spark):
    master = table(spark, S.MASTER, master_row("b", 5, 3, order=None, name="Old", hash_="h"))
    stage = _stage(spark, master_row("b", 5, 3, order=None, name="New", hash_="h2"), master_row("b", 6, 3, order=None, name="More"))
    assert load.merge_upsert(master, stage).count() == 3
    found = load.merge_upsert(master, stage, Options(null_safe_merge=True))
    assert set(bag(found, "trade_db_author_name")) == {("New",), ("More",)}


@pytest.mark.parametrize("bits", [1 << 26, 1 << 15])
def test_flagging(spark, workspace, plans, bits):
    master, stage = _merge_tables(spark)
    master = master.unionByName(
        table(spark, S.MASTER, master_row("z", 8, 8, name="No hash"), master_row(None, 9, 9, name="No book"), master_row(None, 9, 8, name="No book 2", hash_="h3"))
    )
    stage = workspace.stage(stage, "staged")
    marked = load.mark_new_hashes(stage, master, workspace, bits=bits)
    merged = load.merge_upsert(master, marked, Options(run_ts=datetime(2026, 1, 25)), "_unseen")
    assert bag(merged, "trade_db_author_name", "dmc_synced") == {
        ("A", False): 2,
        ("Alone", True): 1,
        ("No id", True): 1,
        ("Fresh", False): 1,
        ("No order", None): 1,
        ("No order 2", None): 1,
        ("No hash", False): 1,
        ("No book", False): 1,
        ("No book 2", True): 1,
    }
    # Rows known to have kept their hash are not asked for; the result is the same.
    kept = workspace.stage(stage.withColumn("_known", F.col("dmc_sync_hash_id") == "h3"), "kept")
    marked = load.mark_new_hashes(kept, master, workspace, "_known", bits=bits)
    assert bag(load.merge_upsert(master, marked, unseen="_unseen"), "trade_db_author_name", "dmc_synced") == bag(
        merged, "trade_db_author_name", "dmc_synced"
    )


def test_no_master_moves_by_its_hash(spark, workspace):
    hashes = spark.range(200_000).select(F.md5(F.col("id").cast("string")).alias("dmc_sync_hash_id"))
    stage = workspace.stage(hashes.filter("dmc_sync_hash_id < '001'"), "staged")
    hits = bitmap.may_hold(hashes, bitmap.bitmap_of(stage, ["dmc_sync_hash_id"]), ["dmc_sync_hash_id"])
    assert stage.count() <= hits.count() <= stage.count() + 50
    plan = hits._jdf.queryExecution().executedPlan().toString()
    # Only the bits move, to be put together and broadcast.
    assert plan.count("Exchange hashpartitioning") == plan.count("hashpartitioning(_bucket") == 1


def test_bootstrap(spark):
    prior = table(
        spark,
        S.PRIOR_DELIVERY,
        {"isbn13": "b", "indigo_contr_id": 1, "indigo_contr_nm": "N", "matched_isni": "TRDB5"},
        {"isbn13": "b", "indigo_contr_id": 1, "indigo_contr_nm": "N", "matched_isni": "TRDB5"},
        {"isbn13": "b", "indigo_contr_id": None, "indigo_contr_nm": "N"},
        {"isbn13": "b", "indigo_contr_id": 1, "indigo_contr_nm": None},
    )
    row = load.bootstrap_load(prior).collect()
    assert len(row) == 1 and row[0]["matched_isni"] is None
    with_placeholder = spark.range(1).select(change_hash(F.lit(None), F.lit(1), F.lit("N"), F.lit("TRDB5"))).first()[0]
    assert row[0]["dmc_sync_hash_id"] == with_placeholder
