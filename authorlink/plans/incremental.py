"""The run that takes what is new or changed since the last delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authorlink.operators.canonical import add_canonical_name, canonical_names, null_placeholder_names
from authorlink.operators.delta import delta_work, feed_credits, master_credits
from authorlink.operators.ids import allocate_ids, known_authors
from authorlink.operators.keys import any_null, lookup, no_null
from authorlink.operators.load import (
    STAGED,
    as_published,
    changes_per_slot,
    drop_isni_placeholders,
    flag_without_hash,
    mark_new_hashes,
    merge_slots,
    overlay_changes,
    overlay_ids,
)
from authorlink.options import Options
from authorlink.plans.linking import link_credits
from authorlink.plans.result import Result
from authorlink.schemas import (
    BY_CONTRIBUTOR,
    BY_NAME,
    BY_NAME_AND_ISBN,
    CREDIT,
    CREDIT_TO_MASTER,
    LINK,
    MASTER,
    MASTER_SLOT,
    NEW,
)
from authorlink.sources.buckets import buckets_of
from authorlink.sources.tables import Inputs, conform, publish_stage
from authorlink.sources.workspace import Workspace

_PAIR = ["trade_db_contributor_id", "matched_isni"]
_OLD_HASH, _KNOWN = "_old_hash", "_known_hash"
_HAS_ID, _NO_ID = "indigo_author_id IS NOT NULL", "indigo_author_id IS NULL"


def run_incremental(
    inputs: Inputs,
    workspace: Workspace,
    options: Options = Options(),
    stage_path: str | None = None,
    work: DataFrame | None = None,
) -> Result:
    """Link new and changed credits, carry the changes into the master, and merge.

    The master is read where it is wanted, with what the run changes laid over it, and written once, by the
    caller. A master in buckets of the slot (``MasterStore``) stays in place throughout; any other is dealt to
    buckets first, which moves it once instead of once for each of its joins.
    The staged rows are written to ``stage_path``, or else into the workspace.
    ``work`` is the work set that ``prepare_matching`` wrote, if it did.
    """
    master = workspace.in_buckets(inputs.matched_author_isbn13, "master", MASTER_SLOT)
    buckets = buckets_of(master, MASTER_SLOT)
    if work is None:
        work = delta_work(feed_credits(inputs.trade_contributors), master)

    def pairs_known(linked: DataFrame) -> DataFrame:
        # The pairs the master has once the CHANGED links are applied: those of the
        # slots left alone, and those of the links that overwrite the others.
        known = master.filter(
            F.col("id_source").isin(BY_NAME, BY_NAME_AND_ISBN, BY_CONTRIBUTOR)
            & F.col("matched_isni").isNotNull()
        )
        new = {c: F.col(c).alias(f"_new_{c}") for c in _PAIR}
        changes = changes_per_slot(linked, buckets).select(*MASTER_SLOT, *new.values(), F.lit(True).alias("_changed"))
        # Every change comes out of this join, and so does what no change meets.
        both = known.select(*MASTER_SLOT, *_PAIR).join(changes, MASTER_SLOT, "full_outer")
        pairs = [F.when(F.col("_changed"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in _PAIR]
        fresh = linked.filter(F.col("delta_flag") == NEW)
        return both.select(*pairs).unionByName(fresh.select(*_PAIR))

    linked = link_credits(
        work,
        inputs,
        pairs_known,
        CREDIT,
        key_has_contributor=True,
        options=options,
        workspace=workspace,
    )

    # The early changes touch a part of these slots with a part of these columns' values,
    # so applying the final changes alone gives the same master.
    changes = changes_per_slot(linked, buckets)
    changes = workspace.stage_in_buckets(changes, "changes", MASTER_SLOT, buckets)
    current = overlay_changes(master, changes)
    pending = workspace.stage(_backfill(current, linked), "pending")
    identified = workspace.stage(_identify(current, pending, workspace, options), "identified")

    pool = null_placeholder_names(_as_credits(current.filter(_HAS_ID)).unionByName(identified))
    published = workspace.stage(_published(pool, options, workspace), "stage")
    stage = published.drop(_KNOWN)
    if stage_path:
        stage = publish_stage(stage, stage_path)

    flagged = mark_new_hashes(published, master, workspace, _KNOWN)
    own = pending.filter(~F.col("_new")).drop("_new")
    found = own.filter(_HAS_ID)
    target = overlay_ids(overlay_changes(master.filter(no_null(MASTER_SLOT)), changes), found)
    # No change ever meets a row with an incomplete slot.
    gap = any_null(MASTER_SLOT)
    beside = master.filter(gap & F.col("indigo_author_id").isNotNull()).unionByName(own.filter(gap))
    if options.null_safe_merge:
        merged = merge_slots(target.unionByName(beside), flagged, options, "_unseen")
    else:
        merged = merge_slots(target, flagged, options, "_unseen").unionByName(flag_without_hash(beside, "_unseen"))
    return Result(conform(merged, MASTER), stage)


def _backfill(current: DataFrame, linked: DataFrame) -> DataFrame:
    """Ids the master knows, for its own rows without one and for NEW credits, in one join.

    Own rows take the highest id of the ISNI and the highest name, NEW credits the
    lowest id. What the master's own rows gain here is no new ISNI, so it does not
    change what NEW credits find.
    """
    fresh = linked.filter(F.col("delta_flag") == NEW).select(*LINK)
    waiting = (
        current.filter(_NO_ID)
        .withColumn("_new", F.lit(False))
        .unionByName(
            fresh.withColumnsRenamed(CREDIT_TO_MASTER)
            .withColumn("_new", F.lit(True)),
            allowMissingColumns=True,
        )
    )
    found = lookup(waiting, known_authors(current), ["matched_isni"])
    own_hit = ~F.col("_new") & F.col("_high_id").isNotNull()
    return found.withColumns(
        {
            "indigo_author_id": F.when(F.col("_new"), F.col("_low_id")).otherwise(F.col("_high_id")),
            "normailized_author_name": F.when(own_hit, F.col("_name")).otherwise(
                F.col("normailized_author_name")
            ),
        }
    ).drop("_low_id", "_high_id", "_name")


def _as_credits(rows: DataFrame) -> DataFrame:
    """Master rows in the words of a credit, with the hash they had."""
    named = master_credits(rows).withColumnsRenamed({"indigo_author_id": "indigo_contr_id", "dmc_sync_hash_id": _OLD_HASH})
    return named.select(*LINK, "indigo_contr_id", _OLD_HASH)


def _identify(current: DataFrame, pending: DataFrame, workspace: Workspace, options: Options) -> DataFrame:
    """The credits that had no id, with new ids where the master knows none."""
    return allocate_ids(_as_credits(pending), current, workspace, "indigo_contr_id", options.id_floor)


def _published(pool: DataFrame, options: Options, workspace: Workspace) -> DataFrame:
    """Resolved rows with their canonical name, and whether their hash is one they had.

    Names are counted over all rows. Rows are made distinct on the few columns
    that decide all others, before those are joined and hashed.
    """
    # Read from a table, so that AQE can split the rows of a busy author.
    names = workspace.stage(canonical_names(pool, "indigo_contr_id", "author_nm"), "names")
    rows = pool.filter(F.col("indigo_contr_id").isNotNull())
    if not options.keep_placeholder_rows:
        rows = drop_isni_placeholders(rows)
    hashes = [F.min(_OLD_HASH).alias("_least"), F.max(_OLD_HASH).alias("_greatest")]
    distinct = rows.groupBy(*LINK, "indigo_contr_id").agg(*hashes)
    named = add_canonical_name(distinct, names, "indigo_contr_id", "indigo_contr_nm")
    published = as_published(named, options, "_least", "_greatest")
    had = F.col("dmc_sync_hash_id").isin(F.col("_least"), F.col("_greatest"))
    published = published.withColumn(_KNOWN, F.coalesce(had, F.lit(False))).drop("_least", "_greatest")
    if options.keep_placeholder_rows:
        # A cleared placeholder can make two rows equal.
        columns = [*STAGED, *(options.audit or {})]
        published = published.groupBy(*columns).agg(F.bool_or(_KNOWN).alias(_KNOWN))
    return published
