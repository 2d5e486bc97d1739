"""What is new in a delivery, compared with the master table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authorlink.functions.names import (
    blank_placeholder,
    full_name_guarded,
    full_name_or_unidentified,
    normalise_name,
)
from authorlink.operators.keys import any_null, collapse_copies, exclude, lookup_flag, no_null
from authorlink.schemas import BOOK, CHANGED, CREDIT, MASTER_SLOT, MASTER_TO_CREDIT, NEW, SAME, SLOT
from authorlink.sources.buckets import buckets_of

_NORM = "author_nm_norm"
EXACT = [*SLOT, "trade_db_contributor_id", _NORM]
SEEN_CREDIT = ["isbn13", "trade_db_contributor_id", "author_nm"]
COPIES = "_copies"


def blank_name_parts(feed: DataFrame) -> DataFrame:
    """Blank name parts that are placeholders."""
    parts = ["contributor_first_name", "contributor_last_name"]
    return feed.withColumns({p: blank_placeholder(F.col(p)) for p in parts})


def cleanse_name_parts(feed: DataFrame) -> DataFrame:
    """Blank name parts that are placeholders; distinct."""
    return blank_name_parts(feed).distinct()


def guarded_credits(cleansed: DataFrame) -> DataFrame:
    """P02 on the feed: distinct credits that have a name."""
    name = full_name_guarded(F.col("contributor_first_name"), F.col("contributor_last_name"))
    return cleansed.withColumn("author_nm", name).select(*CREDIT).filter("author_nm IS NOT NULL").distinct()


def feed_credits(feed: DataFrame, *carried: str) -> DataFrame:
    """P03 on the feed: one credit per feed row, every one with a name."""
    name = full_name_or_unidentified(F.col("contributor_first_name"), F.col("contributor_last_name"))
    return feed.withColumn("author_nm", name).select(*CREDIT, *carried)


def master_credits(master: DataFrame) -> DataFrame:
    """The master in the words of a credit."""
    return master.withColumnsRenamed(MASTER_TO_CREDIT)


def normalised(credits: DataFrame) -> DataFrame:
    """Add the normalised name."""
    return credits.withColumn(_NORM, normalise_name(F.col("author_nm")))


def new_by_existence(credits: DataFrame, master: DataFrame) -> DataFrame:
    """Credits whose book, contributor and raw name the master does not have together.

    Credits dealt like a master in buckets of the book meet it in place.
    """
    split = buckets_of(master, BOOK) is None
    return exclude(credits, master_credits(master), SEEN_CREDIT, split).distinct()


def delta_classify(credits: DataFrame, master: DataFrame) -> DataFrame:
    """Flag each credit NEW, CHANGED or SAME.

    A slot can only be known if its book is, so the slot decides NEW alone. Where the master is in
    buckets of the slot, the credits move to them once, and both joins find all in place.
    """
    known = normalised(master_credits(master))
    buckets = buckets_of(master, MASTER_SLOT)
    credits = credits.repartition(buckets, *SLOT) if buckets else credits
    hashed = buckets is not None
    seen = lookup_flag(normalised(credits), known, EXACT, "_exact", hashed=hashed)
    seen = lookup_flag(seen, known, SLOT, "_slot", hashed=hashed)
    flag = F.when(~F.col("_slot"), NEW).when(~F.col("_exact"), CHANGED).otherwise(SAME)
    return seen.withColumn("delta_flag", flag).drop("_slot", "_exact", _NORM)


def delta_filter(classified: DataFrame) -> DataFrame:
    """The work set, everything that is not SAME."""
    return classified.filter(F.col("delta_flag").isin(NEW, CHANGED))


def delta_work(credits: DataFrame, master: DataFrame) -> DataFrame:
    """P06 and P07 in one: the work set, exact copies collapsed to a count.

    Copies are combined before they move. Unchanged credits, normally nearly all, leave at the
    first join and never reach the second one; where the master is in buckets of the slot, both
    find it in place. A slot with a missing part is never known, so its credits join nothing.
    """
    known = normalised(master_credits(master))
    alone = collapse_copies(credits.filter(any_null(SLOT)), COPIES).withColumn("_slot", F.lit(False))
    unmatched = exclude(normalised(collapse_copies(credits.filter(no_null(SLOT)), COPIES)), known, EXACT)
    seen = lookup_flag(unmatched.drop(_NORM), known, SLOT, "_slot").unionByName(alone)
    flag = F.when(F.col("_slot"), CHANGED).otherwise(NEW)
    return seen.withColumn("delta_flag", flag).drop("_slot")
