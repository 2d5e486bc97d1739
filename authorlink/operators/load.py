"""Changing the master: early updates, staging, merging and flagging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authorlink.functions.hashing import change_hash
from authorlink.operators.bitmap import BITS, bitmap_of, may_hold
from authorlink.operators.delta import master_credits
from authorlink.operators.keys import any_null, lookup, no_null, one_per_key, stacked, update_from
from authorlink.options import Options
from authorlink.schemas import (
    BOOK,
    CHANGED,
    CREDIT_TO_MASTER,
    ISNI_PLACEHOLDER_PREFIX,
    LINK,
    MASTER,
    MERGE_KEY,
    MASTER_SLOT,
    NEW,
    SLOT,
)
from authorlink.sources.buckets import buckets_of
from authorlink.sources.workspace import Workspace

_HASH = "dmc_sync_hash_id"
STAGED = [
    "isbn13",
    "indigo_author_id",
    "trade_db_contributor_id",
    "trade_db_contributor_role",
    "trade_db_contributor_order",
    "matched_isni",
    "normailized_author_name",
    "trade_db_author_name",
    "id_source",
    _HASH,
    "dmc_synced",
    "transformation_id",
]
# What a merge writes; dmc_synced is left to the flagging step.
_MERGED = [c for c in STAGED if c not in ("dmc_synced", "transformation_id")]
_UPDATED = [c for c in _MERGED if c not in MERGE_KEY]


# --- changed credits ----------------------------------------------------------


def changes_per_slot(linked: DataFrame, buckets: int | None = None) -> DataFrame:
    """One CHANGED credit per slot, the lowest; in the words of the master, and dealt like its ``buckets``."""
    changed = linked.filter((F.col("delta_flag") == CHANGED) & no_null(SLOT)).select(*LINK)
    if buckets:
        changed = changed.repartition(buckets, *SLOT)
    order = [c for c in LINK if c not in SLOT]
    return one_per_key(changed, SLOT, order).withColumnsRenamed(CREDIT_TO_MASTER)


def apply_changed(master: DataFrame, linked: DataFrame) -> DataFrame:
    """Overwrite the master rows in the slot of a CHANGED credit; their id must be found anew."""
    return overlay_changes(master, changes_per_slot(linked, buckets_of(master, MASTER_SLOT)))


def overlay_changes(master: DataFrame, changes: DataFrame) -> DataFrame:
    """The master as the changes (one per slot) leave it.

    The master need not be written for that: the small table of changes is laid over it whenever
    it is read, and where it is in buckets of the slot, only the changes move.
    """
    overwritten = ["trade_db_contributor_id", "trade_db_author_name", "matched_isni", "id_source"]
    named = changes.withColumnsRenamed({c: f"_new_{c}" for c in overwritten})
    values: dict[str, Column] = {c: F.col(f"_new_{c}") for c in overwritten}
    values |= {c: F.lit(None) for c in ("indigo_author_id", "normailized_author_name")}
    return update_from(master, named, MASTER_SLOT, values, hashed=buckets_of(master, MASTER_SLOT) is not None)


def overlay_ids(master: DataFrame, found: DataFrame) -> DataFrame:
    """P29 the same way: ``found`` has the id and name of master rows without id, by slot and ISNI."""
    on = [*MASTER_SLOT, "matched_isni"]
    ids = {"indigo_author_id": "_found_id", "normailized_author_name": "_found_name"}
    buckets = buckets_of(master, MASTER_SLOT)
    found = found.repartition(buckets, *MASTER_SLOT) if buckets else found
    of_slot = found.groupBy(*on).agg(*(F.max(c).alias(name) for c, name in ids.items()))
    told = lookup(master, of_slot, on)
    missing = F.col("indigo_author_id").isNull() & F.col("_found_id").isNotNull()
    values = {c: F.when(missing, F.col(name)).otherwise(F.col(c)).alias(c) for c, name in ids.items()}
    return told.select(*(values.get(c, F.col(c)) for c in master.columns))


# --- staging -------------------------------------------------------------------


def stage_rows_full(linked: DataFrame, options: Options = Options()) -> DataFrame:
    """P30, full refresh: every linked credit as a staged row; distinct."""
    return as_staged(linked, options).distinct()


def as_staged(linked: DataFrame, options: Options) -> DataFrame:
    """Links in the words of the master, without id and name."""
    audit = [F.lit(value).alias(name) for name, value in (options.audit or {}).items()]
    staged = linked.select(*LINK).withColumnsRenamed(CREDIT_TO_MASTER)
    return staged.select(
        "isbn13",
        F.lit(None).cast("bigint").alias("indigo_author_id"),
        "trade_db_contributor_id",
        "trade_db_contributor_role",
        "trade_db_contributor_order",
        "matched_isni",
        F.lit(None).cast("string").alias("normailized_author_name"),
        "trade_db_author_name",
        "id_source",
        F.lit(options.transformation_id).cast("bigint").alias("transformation_id"),
        *audit,
    )


def stage_rows_new(linked: DataFrame) -> DataFrame:
    """P30, incremental run: the NEW credits, with room for an id."""
    fresh = linked.filter(F.col("delta_flag") == NEW)
    return fresh.withColumn("indigo_contr_id", F.lit(None).cast("bigint"))


def combine_master_and_new(master: DataFrame, fresh: DataFrame) -> DataFrame:
    """All master rows and the NEW credits under one set of names."""
    known = master_credits(master).withColumnRenamed("indigo_author_id", "indigo_contr_id")
    columns = [*LINK, "indigo_contr_id"]
    return stacked(known.select(*columns), fresh.select(*columns))


def add_change_hash(stage: DataFrame) -> DataFrame:
    """Hash of the values a consumer synchronises."""
    values = ["trade_db_contributor_id", "indigo_author_id", "normailized_author_name", "matched_isni"]
    return stage.withColumn(_HASH, change_hash(*[F.col(c) for c in values]))


def _is_placeholder(isni: Column) -> Column:
    return F.coalesce(isni.ilike(f"{ISNI_PLACEHOLDER_PREFIX}%"), F.lit(False))


def clear_isni_placeholders(stage: DataFrame) -> DataFrame:
    """P37, full refresh: placeholders become NULL."""
    isni = F.col("matched_isni")
    return stage.withColumn("matched_isni", F.when(~_is_placeholder(isni), isni))


def drop_isni_placeholders(rows: DataFrame) -> DataFrame:
    """P37, incremental run: rows with a placeholder are not staged."""
    return rows.filter(~_is_placeholder(F.col("matched_isni")))


def drop_unresolved(
    stage: DataFrame, id_column: str = "indigo_author_id", name_column: str = "normailized_author_name"
) -> DataFrame:
    """Only rows with both an id and a canonical name can be loaded."""
    return stage.filter(F.col(id_column).isNotNull() & F.col(name_column).isNotNull())


def stage_resolved(rows: DataFrame, options: Options = Options(), buckets: int | None = None) -> DataFrame:
    """P36 to P39 for combined rows: the resolved ones, ready to be published; distinct, and dealt to ``buckets`` of the slot.

    Rows are made distinct on the columns that decide all others, before they are hashed.
    """
    rows = drop_unresolved(rows, "indigo_contr_id", "indigo_contr_nm")
    if not options.keep_placeholder_rows:
        rows = drop_isni_placeholders(rows)
    rows = rows.select(*LINK, "indigo_contr_id", "indigo_contr_nm")
    published = as_published((rows.repartition(buckets, *SLOT) if buckets else rows).distinct(), options)
    # A cleared placeholder can make two rows equal.
    return published.distinct() if options.keep_placeholder_rows else published


def as_published(rows: DataFrame, options: Options, *carried: str) -> DataFrame:
    """Resolved combined rows, hashed and labelled, in the words of the master; ``carried`` columns follow."""
    rows = drop_unresolved(rows, "indigo_contr_id", "indigo_contr_nm")
    if not options.keep_placeholder_rows:
        rows = drop_isni_placeholders(rows)
    renamed = rows.withColumnsRenamed(
        CREDIT_TO_MASTER
        | {"indigo_contr_id": "indigo_author_id", "indigo_contr_nm": "normailized_author_name"}
    )
    hashed = add_change_hash(renamed)
    if options.keep_placeholder_rows:
        hashed = clear_isni_placeholders(hashed)
    audit = {name: F.lit(value) for name, value in (options.audit or {}).items()}
    labelled = hashed.withColumns(
        {
            "dmc_synced": F.lit(True),
            "transformation_id": F.lit(options.transformation_id).cast("bigint"),
            **audit,
        }
    )
    return labelled.select(*STAGED, *audit, *carried)


def _dealt(rows: DataFrame) -> tuple[list[str], int | None]:
    """Of what, and into how many buckets, the master or staged ``rows`` are dealt: of the slot, or of the book."""
    of_book = buckets_of(rows, BOOK)
    return (BOOK, of_book) if of_book else (MASTER_SLOT, buckets_of(rows, MASTER_SLOT))


# --- merging -------------------------------------------------------------------


def snapshot_hashes(master: DataFrame) -> DataFrame:
    """The hashes known before a merge, as a table; ``mark_new_hashes`` asks the master itself."""
    return master.select(_HASH).distinct()


def mark_new_hashes(
    stage: DataFrame,
    master: DataFrame,
    workspace: Workspace,
    known: str | None = None,
    bits: int = BITS,
) -> DataFrame:
    """P42 before the merge: ``_unseen`` tells which staged hashes no row of the old master has.

    Every hash of the merged master is the row's own old one or a staged one, so nothing of
    the merged master has to be looked up. ``known`` names a column that is true where the staged
    row has the hash it had in the master; those rows are not looked up either. The old
    master passes a bitmap of the hashes in question where it lies, and only hits move. ``stage`` is read
    several times, so it should be written.
    """
    asked = stage.filter(~F.col(known)) if known else stage
    bitmap = bitmap_of(asked.select(_HASH).filter(F.col(_HASH).isNotNull()), [_HASH], bits)
    hits = may_hold(master.select(_HASH).filter(F.col(_HASH).isNotNull()), bitmap, [_HASH], bits)
    # An author's many books have one hash, and of a table Catalyst knows the size: to meet few hashes nothing is moved.
    hits = workspace.stage(hits.distinct(), "hits")
    told = lookup(asked, hits.withColumn("_seen", F.lit(True)), [_HASH])
    told = told.withColumn("_unseen", F.col("_seen").isNull()).drop("_seen")
    keys, buckets = _dealt(stage)
    told = workspace.stage_dealt(told, "asked", keys, buckets) if buckets else workspace.stage(told, "asked")
    return told.unionByName(stage.filter(known).withColumn("_unseen", F.lit(False))) if known else told


def _one_per_merge_key(stage: DataFrame, strict: bool, carried: list[str]) -> DataFrame:
    order = ["trade_db_author_name", "matched_isni", "id_source"]
    rows = stage.select(*_MERGED, *carried)
    if not strict:
        return one_per_key(rows, MERGE_KEY, order)
    distinct = rows.distinct()
    counts = distinct.groupBy(*MERGE_KEY).agg(
        F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in [*_UPDATED, *carried]]
    )
    message = F.lit("several staged rows meet on one merge key")
    # The check is part of a merged column, so that it cannot be pruned away.
    checked = F.when(F.col("_n") > 1, F.raise_error(message).cast("string")).otherwise(F.col(_HASH))
    return counts.withColumn(_HASH, checked).select(*_MERGED, *carried)


def merge_upsert(
    master: DataFrame, stage: DataFrame, options: Options = Options(), unseen: str | None = None
) -> DataFrame:
    """Update master rows that meet a staged row on the merge key, insert the other staged rows.

    Incomplete keys never meet, unless NULL counts as a value; master rows with an incomplete slot go
    around the join then. ``unseen`` names the column of ``mark_new_hashes``; with it the merge does P42 as well.
    """
    if options.null_safe_merge:
        return merge_slots(master, stage, options, unseen)
    merged = merge_slots(master.filter(no_null(MASTER_SLOT)), stage, options, unseen)
    return merged.unionByName(flag_without_hash(master.filter(any_null(MASTER_SLOT)), unseen))


def flag_without_hash(rows: DataFrame, unseen: str | None) -> DataFrame:
    """P42 for master rows that meet nothing: their hash is an old one, if they have one."""
    columns = [f.name for f in MASTER]
    synced = F.when(F.col(_HASH).isNull(), F.lit(False)).otherwise(F.col("dmc_synced"))
    return rows.withColumn("dmc_synced", synced).select(*columns) if unseen else rows.select(*columns)


def merge_slots(
    target: DataFrame, stage: DataFrame, options: Options = Options(), unseen: str | None = None
) -> DataFrame:
    """``merge_upsert`` without a way around for rows with an incomplete slot.

    One full outer join. The key is nearly unique on either side, since the staged rows are combined
    on it, so no side has a hot one. A master in buckets stays where it is.
    """
    run_ts = F.lit(options.run_ts) if options.run_ts else F.current_timestamp()
    run_ts, run_id = run_ts.cast("timestamp_ntz"), F.lit(options.transformation_id).cast("bigint")
    columns, carried = [f.name for f in MASTER], [unseen] if unseen else []
    target = target.select(*columns)
    flag = F.when(F.col(unseen), F.lit(False)) if unseen else F.lit(None).cast("boolean")

    source, alone = stage, None
    if not options.null_safe_merge:
        made = {c: F.lit(None).cast(MASTER[c].dataType) for c in columns if c not in _MERGED}
        inserted = stage.filter(any_null(MERGE_KEY)).select(*_MERGED, *carried)
        alone = inserted.withColumns(made | {"transformation_id": run_id, "dmc_synced": flag}).select(*columns)
        source = stage.filter(no_null(MERGE_KEY))
    # Staged rows are nearly unique too, and combining them before the shuffle would only sort
    # everything twice; the join goes on with the order made here.
    keys, buckets = _dealt(target)
    if not buckets:
        source = source.repartition(*MERGE_KEY)
    elif buckets_of(source, keys) != buckets:
        source = source.repartition(buckets, *keys)
    source = _one_per_merge_key(source, options.strict_merge, carried)
    new = source.withColumnsRenamed({c: f"_new_{c}" for c in _MERGED}).withColumn("_staged", F.lit(True))
    old = target.withColumn("_known", F.lit(True))
    on = F.lit(True)
    for c in MERGE_KEY:
        one, other = old[c], new[f"_new_{c}"]
        on = on & (one.eqNullSafe(other) if options.null_safe_merge else one == other)
    joined = old.join(new, on, "full_outer")
    met, fresh, staged = F.col("_known") & F.col("_staged"), F.col("_known").isNull(), F.col("_staged")
    values = {c: F.when(staged, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in _UPDATED}
    values |= {c: F.when(fresh, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in MERGE_KEY}
    values |= {"etl_updated_date": F.when(met, run_ts).otherwise(F.col("etl_updated_date"))}
    values |= {"transformation_id": F.when(staged, run_id).otherwise(F.col("transformation_id"))}
    if unseen:
        # A row that meets nothing keeps its hash, which is an old one unless it is NULL.
        stale = F.when(staged, F.col(unseen)).otherwise(F.col(_HASH).isNull())
        values |= {"dmc_synced": F.when(stale, F.lit(False)).otherwise(F.col("dmc_synced"))}
    merged = joined.withColumns(values).select(*columns)
    return merged if alone is None else merged.unionByName(alone)


# --- first load ------------------------------------------------------------------


def bootstrap_load(prior: DataFrame, options: Options = Options()) -> DataFrame:
    """The first master, from the result of an earlier delivery.

    Hashes are taken before placeholders are cleared.
    """
    renamed = prior.withColumnsRenamed(
        CREDIT_TO_MASTER
        | {"indigo_contr_id": "indigo_author_id", "indigo_contr_nm": "normailized_author_name"}
    )
    loaded = add_change_hash(renamed).withColumns(
        {
            "dmc_synced": F.lit(True),
            "transformation_id": F.lit(options.transformation_id).cast("bigint"),
        }
    )
    return drop_unresolved(clear_isni_placeholders(loaded.select(*STAGED).distinct()))
