"""Author ids: carried over from the master, or newly numbered."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authorlink.operators.keys import lookup, stacked, update_from
from authorlink.operators.matching import isni_placeholder
from authorlink.schemas import MASTER_SLOT
from authorlink.sources.buckets import buckets_of
from authorlink.sources.workspace import Workspace

_ISNI = ["matched_isni"]


def known_authors(master: DataFrame) -> DataFrame:
    """Per ISNI of the master: lowest and highest id and highest canonical name, where there is an id.

    An author's many books are one row a task before the shuffle.
    """
    identified = master.filter("matched_isni IS NOT NULL AND indigo_author_id IS NOT NULL")
    return identified.groupBy(*_ISNI).agg(
        F.min("indigo_author_id").alias("_low_id"),
        F.max("indigo_author_id").alias("_high_id"),
        F.max("normailized_author_name").alias("_name"),
    )


def backfill_master_ids(master: DataFrame, authors: DataFrame | None = None) -> DataFrame:
    """Master rows without id take id and name known for their ISNI.

    Only the rows without id take part in the join; they go back to the buckets of a master that lies in some.
    ``authors`` is the written ``known_authors(master)``: of a table Catalyst knows the size, and moves nothing to meet a small one.
    """
    has_id = F.col("indigo_author_id").isNotNull()
    without = master.filter(~has_id)
    values = {"indigo_author_id": F.col("_high_id"), "normailized_author_name": F.col("_name")}
    filled = update_from(without, known_authors(master) if authors is None else authors, _ISNI, values)
    buckets = buckets_of(master, MASTER_SLOT)
    filled = filled.repartition(buckets, *MASTER_SLOT) if buckets else filled
    return stacked(master.filter(has_id), filled)


def lowest_ids(master: DataFrame) -> DataFrame:
    """Per ISNI of the master the lowest id, if it has any."""
    return _lowest_id(master, F.col("matched_isni"))


def lowest_stage_ids_full(master: DataFrame) -> DataFrame:
    """The same per ISNI, or per its placeholder."""
    return _lowest_id(master, F.coalesce("matched_isni", isni_placeholder(F.col("trade_db_contributor_id"))))


def _lowest_id(master: DataFrame, key: Column) -> DataFrame:
    keyed = master.select(key.alias("matched_isni"), "indigo_author_id").filter("matched_isni IS NOT NULL")
    return keyed.groupBy(*_ISNI).agg(F.min("indigo_author_id").alias("_id"))


def backfill_stage_ids_full(stage: DataFrame, master: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """P31, full refresh: the id the master has for the ISNI, or for its placeholder.

    ``known`` is the written ``lowest_stage_ids_full(master)``.
    """
    known = lowest_stage_ids_full(master) if known is None else known
    return update_from(stage, known, _ISNI, {"indigo_author_id": F.col("_id")})


def backfill_ids(rows: DataFrame, master: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """P31, incremental run: rows without id take the lowest id the master has for the ISNI.

    ``known`` is the written ``lowest_ids(master)``.
    """
    found = lookup(rows, lowest_ids(master) if known is None else known, _ISNI)
    return found.withColumn("indigo_contr_id", F.coalesce("indigo_contr_id", "_id")).drop("_id")


def number_densely(values: DataFrame, column: str, number: str, workspace: Workspace) -> DataFrame:
    """Number distinct values 1, 2, … in their order, without one task seeing them all.

    Values are range partitioned, sorted, and written with the number of their part and their place
    in it, which therefore stay what they were. The driver only adds up one count per part.
    """
    place = F.monotonically_increasing_id()  # the part, and from bit 33 down the place in it
    ordered = values.repartitionByRange(F.col(column)).sortWithinPartitions(column)
    placed = ordered.withColumn("_place", place).withColumns(
        {"_part": F.shiftright("_place", 33), "_place": F.col("_place").bitwiseAND((1 << 33) - 1)}
    )
    parts = workspace.stage(placed, "numbering")
    counts = sorted(parts.groupBy("_part").count().collect())
    offsets = accumulate((n for _, n in counts), initial=1)
    starts = [(part, start) for (part, _), start in zip(counts, offsets)]
    before = values.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    # One row per part, so its size is bounded by the number of shuffle partitions.
    return parts.join(F.broadcast(before), "_part").select(column, (F.col("_start") + F.col("_place")).alias(number))


def allocate_ids(
    rows: DataFrame,
    master: DataFrame | None,
    workspace: Workspace,
    id_column: str,
    id_floor: int | None = None,
) -> DataFrame:
    """Number the ISNIs that still have no id, from the highest id in use.

    ``master`` adds ids in use that ``rows`` does not hold. Without any id in
    use new ids are NULL, unless ``id_floor`` says where to start. Only rows
    without id take part in the join.
    """
    used = rows.select(F.col(id_column).alias("_used"))
    if master is not None:
        used = used.unionByName(master.select(F.col("indigo_author_id").alias("_used")))
    highest = used.agg(F.max("_used")).first()[0]
    highest = id_floor if highest is None else highest

    has_id = F.col(id_column).isNotNull()
    without = rows.filter(~has_id)
    wanted = without.select("matched_isni").filter("matched_isni IS NOT NULL").distinct()
    numbered = number_densely(wanted, "matched_isni", "_number", workspace)
    new_ids = numbered.select("matched_isni", (F.lit(highest).cast("bigint") + F.col("_number")).alias("_new_id"))
    new_ids = workspace.stage(new_ids, "new_ids")  # of a table Catalyst knows the size
    given = update_from(without, new_ids, _ISNI, {id_column: F.col("_new_id")})
    return stacked(rows.filter(has_id), given)
