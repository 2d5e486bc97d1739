"""One query per operator, on the tables derived in ``fixtures``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authorlink.functions.names import full_name_or_unidentified, normalise_name
from authorlink.operators.delta import feed_credits
from authorlink.operators.load import bootstrap_load, drop_isni_placeholders
from authorlink.plans.bootstrap import run_bootstrap
from authorlink.plans.full_refresh import run_full_refresh
from authorlink.plans.incremental import run_incremental
from authorlink.plans.prepare import prepare_matching
from authorlink.sources.buckets import buckets_for
from authorlink.sources.store import MasterStore
from authorlink.sources.workspace import Workspace
from authorlink.verify.fixtures import Fixtures
from authorlink.verify.steps import FullRefreshSteps, IncrementalSteps

Query = Callable[[SparkSession, str], DataFrame]


def _untimed(rows: DataFrame) -> DataFrame:
    """Without the time of the run, which no two runs share."""
    return rows.drop("etl_updated_date")


def _step(kind: type, key: str, name: str) -> Query:
    # From the third bucket on, the inputs are read so often that they are written first.
    written = int(key[1:3]) >= 18

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workspace = Workspace(spark)
        inputs = Fixtures(spark, sf_dir).inputs(workspace if written else None)
        return _untimed(getattr(kind(inputs, workspace), name))

    return run


def _source(build: Callable[[Fixtures], DataFrame], odd: bool = False) -> Query:
    return lambda spark, sf_dir: _untimed(build(Fixtures(spark, sf_dir, odd)))


def _whole(run: Callable, part: str, odd: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        workspace = Workspace(spark)
        result = run(Fixtures(spark, sf_dir, odd).inputs(workspace), workspace)
        return _untimed(getattr(result, part))

    return query


def _published(run: Callable) -> Query:
    """The master as the next run finds it: read from a store in buckets, and published there."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        workspace = Workspace(spark)
        inputs = Fixtures(spark, sf_dir).inputs(workspace)
        store = MasterStore(spark, f"{workspace.path}/store")
        store.publish(inputs.matched_author_isbn13, buckets=buckets_for(inputs.matched_author_isbn13.count()))
        result = run(replace(inputs, matched_author_isbn13=store.master()), workspace)
        store.publish(result.master, result.stage)
        return _untimed(store.master())

    return query


def _prepared(incremental: bool, part: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        workspace = Workspace(spark)
        made = prepare_matching(Fixtures(spark, sf_dir).inputs(workspace), workspace, incremental)
        return getattr(made, part)

    return query


def _isni_names(fixtures: Fixtures) -> DataFrame:
    name = full_name_or_unidentified(F.col("first_name"), F.col("last_name"))
    return fixtures.isni_authors.select("isni", name.alias("full_name"))


def _normalised_names(fixtures: Fixtures) -> DataFrame:
    """The names of all credits, of the feed and of the master."""
    credits = feed_credits(fixtures.trade_contributors)
    known = fixtures.matched_author_isbn13.select("isbn13", F.col("trade_db_author_name").alias("author_nm"))
    names = credits.select("isbn13", "author_nm").unionByName(known)
    return names.withColumn("author_nm_norm", normalise_name(F.col("author_nm")))


FULL_STEPS = {
    "p01_cleanse_name_parts": "cleansed",
    "p02_full_name_guarded": "credits",
    "p05_detect_new_by_existence": "work",
    "p12_residual_after_isni_full": "residual_1",
    "p15_match_status_full": "status",
    "p18_residual_after_prefilled_full": "residual_2",
    "p21_known_isni_pairs_full": "pairs",
    "p24_residual_after_contributor_full": "residual_3",
    "p30_stage_rows_full": "staged",
    "p31_backfill_stage_ids_full": "known",
    "p33_allocate_ids_full": "allocated",
    "p35_canonical_name_full": "named",
    "p36_change_hash": "hashed",
    "p37_clear_isni_placeholders": "cleared",
    "p38_drop_unresolved": "resolved",
    "p41_merge_upsert_full": "merged",
    "p42_flag_unsynced_full": "flagged",
}
INCREMENTAL_STEPS = {
    "p06_delta_classify": "classified",
    "p07_delta_filter": "work",
    "p07_delta_work": "collapsed",
    "p10_split_unique": "unique",
    "p10_split_ambiguous": "ambiguous",
    "p11_bucket_isni": "by_name",
    "p12_residual_after_isni": "residual_1",
    "p13_isni_full_names": "full_names",
    "p14_isni_book_authors": "book_authors",
    "p15_match_status": "status",
    "p16_bucket_prefilled": "prefilled",
    "p17_singletons": "prefilled_single",
    "p18_residual_after_prefilled": "residual_2",
    "p19_combine_isni": "combined_1",
    "p20_apply_changed_early": "master_1",
    "p21_known_isni_pairs": "pairs",
    "p22_unique_isni_per_contributor": "unique_isni",
    "p23_bucket_tradedb_isni": "by_contributor",
    "p24_residual_after_contributor": "residual_3",
    "p25_combine_2": "combined_2",
    "p26_bucket_tradedb": "fallback",
    "p27_combine_3": "combined_3",
    "p28_apply_changed_final": "master_2",
    "p29_backfill_master_ids": "master_3",
    "p29_known_authors": "authors",
    "p30_stage_rows_new": "fresh",
    "p31_backfill_new_ids": "fresh_known",
    "p31_backfill_combined_ids": "combined_known",
    "p32_combine_base_and_new": "combined",
    "p33_allocate_ids": "allocated",
    "p34_null_placeholder_names": "without_placeholders",
    "p35_canonical_name": "named",
    "p39_publish_stage": "stage",
    "p40_snapshot_hashes": "old_hashes",
    "p41_merge_upsert": "merged",
    "p42_flag_unsynced": "flagged",
    "p42_mark_new_hashes": "marked",
}


def queries() -> dict[str, Query]:
    def dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
        return drop_isni_placeholders(_step(IncrementalSteps, "p37", "named")(spark, sf_dir))

    found = {key: _step(FullRefreshSteps, key, name) for key, name in FULL_STEPS.items()}
    found |= {key: _step(IncrementalSteps, key, name) for key, name in INCREMENTAL_STEPS.items()}
    found |= {
        "p03_full_name_feed": _source(lambda f: feed_credits(f.trade_contributors)),
        "p03_full_name_isni": _source(_isni_names),
        "p04_normalise_name": _source(_normalised_names),
        "p04_normalise_name_odd": _source(_normalised_names, odd=True),
        "p08_match_input_names_full": _prepared(False, "names"),
        "p08_match_input_names": _prepared(True, "names"),
        "p09_isni_match_input_full": _prepared(False, "holders"),
        "p09_isni_match_input": _prepared(True, "holders"),
        "p37_drop_isni_placeholders": dropped,
        "p43_bootstrap_load": _source(lambda f: bootstrap_load(f.book_ref_prior)),
        "p43_run_bootstrap": _source(lambda f: run_bootstrap(f.book_ref_prior)),
        "p44_run_full_refresh_base": _whole(run_full_refresh, "master"),
        "p44_run_full_refresh_stage": _whole(run_full_refresh, "stage"),
        "p43_run_bootstrap_odd": _source(lambda f: run_bootstrap(f.book_ref_prior), odd=True),
        "p44_run_full_refresh_odd_base": _whole(run_full_refresh, "master", odd=True),
        "p44_run_full_refresh_odd_stage": _whole(run_full_refresh, "stage", odd=True),
        "p45_run_incremental_odd_base": _whole(run_incremental, "master", odd=True),
        "p45_run_incremental_odd_stage": _whole(run_incremental, "stage", odd=True),
        "p44_run_full_refresh_published": _published(run_full_refresh),
        "p45_run_incremental_published": _published(run_incremental),
        "p45_run_incremental_base": _whole(run_incremental, "master"),
        "p45_run_incremental_stage": _whole(run_incremental, "stage"),
    }
    return dict(sorted(found.items()))
