"""The run that takes every credit the master does not have yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authorlink.operators.canonical import add_canonical_name, canonical_names
from authorlink.operators.delta import (
    COPIES,
    SEEN_CREDIT,
    blank_name_parts,
    guarded_credits,
    master_credits,
)
from authorlink.operators.ids import allocate_ids, backfill_stage_ids_full, lowest_stage_ids_full
from authorlink.operators.keys import exclude
from authorlink.operators.load import (
    STAGED,
    add_change_hash,
    as_staged,
    clear_isni_placeholders,
    drop_unresolved,
    mark_new_hashes,
    merge_upsert,
)
from authorlink.operators.matching import BOOK_AND_NAME
from authorlink.options import Options
from authorlink.plans.linking import link_credits
from authorlink.plans.result import Result
from authorlink.schemas import BOOK, BY_NAME, BY_NAME_AND_ISBN, MASTER
from authorlink.sources.buckets import buckets_for
from authorlink.sources.tables import Inputs, conform, publish_stage
from authorlink.sources.workspace import Workspace

_PAIR = ["trade_db_contributor_id", "matched_isni"]


def unseen_credits(inputs: Inputs) -> DataFrame:
    """The work set: credits that the master does not have.

    They are dealt to the buckets of their book first, where they are made distinct and meet the master's.
    """
    feed = inputs.trade_contributors
    buckets = buckets_for(feed.count())
    credits = guarded_credits(blank_name_parts(feed.repartition(buckets, *BOOK)))
    known = master_credits(inputs.matched_author_isbn13).select(*SEEN_CREDIT).repartition(buckets, *BOOK)
    return exclude(credits, known, SEEN_CREDIT)


def run_full_refresh(
    inputs: Inputs,
    workspace: Workspace,
    options: Options = Options(),
    stage_path: str | None = None,
    work: DataFrame | None = None,
) -> Result:
    """Stage all credits that are not in the master, give them ids and names, and merge them.

    The credits are dealt to buckets of their book once, and stay there up to the merge. What is looked up for
    contributors and authors is written first, so that Catalyst knows its size and moves no credits to meet a small table.
    The staged rows are written to ``stage_path``, or else into the workspace.
    ``work`` is the work set that ``prepare_matching`` wrote, if it did.
    """
    master = inputs.matched_author_isbn13
    work = unseen_credits(inputs) if work is None else work
    buckets = buckets_for(inputs.trade_contributors.count())

    def pairs_known(linked: DataFrame) -> DataFrame:
        known = master.filter(F.col("id_source").isin(BY_NAME, BY_NAME_AND_ISBN))
        return linked.select(*_PAIR).unionByName(known.select(*_PAIR))

    linked = link_credits(
        work.withColumn(COPIES, F.lit(1).cast("bigint")),
        inputs,
        pairs_known,
        BOOK_AND_NAME,
        key_has_contributor=False,
        options=options,
        workspace=workspace,
        dealt=(BOOK, buckets),
    )

    lowest = workspace.stage(lowest_stage_ids_full(master), "known_ids")
    known = backfill_stage_ids_full(as_staged(linked, options), master, lowest)
    known = workspace.stage_dealt(known, "known", BOOK, buckets)
    identified = allocate_ids(known, master, workspace, "indigo_author_id", options.id_floor)
    identified = workspace.stage_dealt(identified, "identified", BOOK, buckets)

    names = canonical_names(identified, "indigo_author_id", "trade_db_author_name")
    names = workspace.stage(names, "names")
    named = add_canonical_name(identified, names, "indigo_author_id", "normailized_author_name")
    resolved = drop_unresolved(clear_isni_placeholders(add_change_hash(named)))
    resolved = resolved.withColumn("dmc_synced", F.lit(None).cast("boolean"))
    resolved = resolved.select(*STAGED, *(options.audit or {}))
    stage = publish_stage(resolved, stage_path) if stage_path else workspace.stage(resolved, "stage")

    flagged = mark_new_hashes(stage, master, workspace)
    merged = merge_upsert(master, flagged, options, "_unseen")
    return Result(conform(merged, MASTER), stage)
