"""Linking credits to ISNIs, by ever weaker evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from authorlink.functions.names import full_name_guarded, full_name_or_unidentified, full_name_strict
from authorlink.operators.delta import master_credits
from authorlink.operators.keys import lookup, mark_taken, match, no_null, singletons, stacked
from authorlink.schemas import (
    AMBIGUOUS_FLAG,
    BY_CONTRIBUTOR,
    BY_NAME,
    BY_NAME_AND_ISBN,
    CONFLICT,
    FALLBACK,
    ISNI_PLACEHOLDER_PREFIX,
    LINK,
    NAMES_NOT_MATCHED,
    NEW,
    NO_MATCH,
    SLOT,
    UNDETERMINED,
    UNIQUE_MATCH,
)

SINGLE = [*SLOT, "author_nm"]
BOOK_AND_NAME = ["isbn13", "author_nm"]


# --- tables for and from the matcher ---------------------------------------


def match_input_names(work: DataFrame, skip_placeholders: bool) -> DataFrame:
    """The distinct names to be matched."""
    names = work.select("author_nm")
    if skip_placeholders:
        names = names.filter(~F.upper("author_nm").isin(*NAMES_NOT_MATCHED))
    return names.distinct()


def isni_match_input_full(isni_authors: DataFrame) -> DataFrame:
    """P09, full refresh: ISNI holders with their name parts and full name."""
    author = full_name_guarded(F.col("first_name"), F.col("last_name"))
    return isni_authors.select("isni", "first_name", "last_name", author.alias("author")).distinct()


def isni_match_input_incremental(isni_authors: DataFrame) -> DataFrame:
    """P09, incremental run: ISNI holders with the plainly joined name."""
    author = full_name_strict(F.col("first_name"), F.col("last_name"))
    return isni_authors.select("isni", author.alias("author")).distinct()


def unique_matches(engine_output: DataFrame) -> DataFrame:
    """P10: names the matcher gave one ISNI."""
    return engine_output.filter(F.col("dup_name_flag").isNull())


def ambiguous_matches(engine_output: DataFrame) -> DataFrame:
    """P10: names the matcher gave several ISNIs."""
    return engine_output.filter(F.col("dup_name_flag") == AMBIGUOUS_FLAG)


# --- evidence 1: the name alone ---------------------------------------------


def _label(isni: str, label: str) -> Column:
    return F.when(F.col(isni).isNotNull(), F.lit(label)).alias("ref_to")


def bucket_isni(work: DataFrame, unique: DataFrame) -> DataFrame:
    """Link by a uniquely matched name."""
    found = lookup(work, unique.select("author_nm", "matched_isni"), ["author_nm"])
    return found.select("*", _label("matched_isni", BY_NAME))


# --- evidence 2: an ambiguous name, confirmed by the book --------------------


def isni_full_names(isni_authors: DataFrame) -> DataFrame:
    """Distinct ISNIs with the full name of the holder."""
    name = full_name_or_unidentified(F.col("first_name"), F.col("last_name"))
    return isni_authors.select("isni", name.alias("full_name")).distinct()


def isni_book_authors(
    isni_isbns: DataFrame, full_names: DataFrame
) -> DataFrame:
    """Books of each ISNI holder, with the holder's name."""
    books = isni_isbns.select("isbn13", "isni").distinct()
    return match(books, full_names, ["isni"])


def match_status(
    residual: DataFrame,
    book_authors: DataFrame,
    ambiguous: DataFrame,
    show_sources: bool,
) -> DataFrame:
    """Compare the ISNI known for book and name with what the matcher proposed."""
    by_book = book_authors.withColumnRenamed("full_name", "author_nm")
    proposed = ambiguous.select("author_nm", F.col("matched_isni").alias("isni"))
    # The proposal is only looked up under the ISNI of the book, so where there is
    # one, it is that ISNI.
    proposed = proposed.withColumn("engine_matched_isni", F.col("isni"))
    found = lookup(lookup(residual, by_book, BOOK_AND_NAME), proposed, ["author_nm", "isni"])
    known, engine = F.col("isni"), F.col("engine_matched_isni")
    status = (
        F.when(known == engine, UNIQUE_MATCH)
        .when(known != engine, CONFLICT)
        .when(known.isNull(), NO_MATCH)
        .otherwise(UNDETERMINED)
    )
    sources = ["isni", "engine_matched_isni"] if show_sources else []
    return found.select(
        *residual.columns,
        *sources,
        F.coalesce(known, engine).alias("final_isni"),
        status.alias("match_status"),
    )


def bucket_prefilled(status: DataFrame) -> DataFrame:
    """Candidates confirmed by the book."""
    kept = [c for c in status.columns if c not in ("match_status", "isni", "engine_matched_isni")]
    return status.filter(F.col("match_status") == UNIQUE_MATCH).select(
        *kept, F.lit(BY_NAME_AND_ISBN).alias("ref_to")
    )


def confirmed_names(
    isni_isbns: DataFrame, isni_authors: DataFrame, ambiguous: DataFrame
) -> DataFrame:
    """Book and name wherever a book confirms a proposal of the matcher, and the ISNI if there is one alone.

    P13, P14 and the proposals of P15, joined the other way round: holders that were
    not proposed drop out before their books are read. All tables meet by ISNI. ``single``
    is NULL where several proposals are confirmed, be they equal ones.
    """
    proposed = ambiguous.select("author_nm", F.col("matched_isni").alias("isni")).repartition("isni")
    proposed = proposed.groupBy("author_nm", "isni").agg(F.count(F.lit(1)).alias("_times"))
    holders = isni_full_names(isni_authors.repartition("isni")).withColumnRenamed("full_name", "author_nm")
    books = match(isni_isbns.select("isbn13", "isni"), match(proposed, holders, ["author_nm", "isni"]), ["isni"])
    of_name = books.groupBy(*BOOK_AND_NAME).agg(
        F.min("isni").alias("_least"), F.max("isni").alias("_greatest"), F.max("_times").alias("_times")
    )
    alone = (F.col("_least") == F.col("_greatest")) & (F.col("_times") == 1)
    return of_name.select(*BOOK_AND_NAME, F.lit(True).alias("confirmed"), F.when(alone, F.col("_least")).alias("single"))


def mark_prefilled(
    residual: DataFrame, confirmed: DataFrame, key: list[str], copies: str, taken: str
) -> DataFrame:
    """P15 to P18 in one pass: the links by book and name, and whether a row's key has one.

    The rows meet the confirmed names once, and the partitioning of that join, on book
    and name, serves to tell single candidates and to mark keys. ``residual`` has
    distinct credits, and ``copies`` how often each occurs.
    """
    found = lookup(residual, confirmed, BOOK_AND_NAME)
    candidates = F.sum(F.when(F.col("confirmed"), F.col(copies))).over(Window.partitionBy(*SINGLE))
    is_single = (candidates == 1) & no_null(SINGLE)
    told = found.withColumn("matched_isni", F.when(is_single, F.col("single")))
    told = told.withColumn("ref_to", _label("matched_isni", BY_NAME_AND_ISBN)).drop("confirmed", "single")
    return mark_taken(told, key, taken)


def single_candidates(candidates: DataFrame, copies: str | None = None) -> DataFrame:
    """Drop candidates where one slot and name has several."""
    return singletons(candidates, SINGLE, copies)


# --- evidence 3: the only ISNI known for the contributor ---------------------


def combine_isni(by_name: DataFrame, prefilled: DataFrame) -> DataFrame:
    """The links by name and by name and book."""
    return stacked(_linked(by_name), _linked(prefilled.withColumnRenamed("final_isni", "matched_isni"))).distinct()


def known_isni_pairs(linked: DataFrame, master: DataFrame, sources: tuple[str, ...], only_new: bool) -> DataFrame:
    """Credits with an ISNI, from this run and from the master."""
    if only_new:
        linked = linked.filter(F.col("delta_flag") == NEW)
    known = master_credits(master).filter(F.col("ref_to").isin(*sources))
    return stacked(linked.select(*LINK), known.select(*LINK)).distinct()


def unique_isni_per_contributor(pairs: DataFrame) -> DataFrame:
    """Contributors known under exactly one ISNI.

    The least ISNI is the greatest if there is only one, and both combine before the
    shuffle, so a busy contributor is one row a task.
    """
    grouped = pairs.groupBy("trade_db_contributor_id").agg(
        F.max("matched_isni").alias("matched_isni"), F.min("matched_isni").alias("_least")
    )
    return grouped.filter(F.col("matched_isni") == F.col("_least")).drop("_least")


def bucket_tradedb_isni(residual: DataFrame, unique: DataFrame) -> DataFrame:
    """Link by the contributor's only known ISNI."""
    found = lookup(residual, unique, ["trade_db_contributor_id"])
    return found.select("*", _label("matched_isni", BY_CONTRIBUTOR))


# --- no evidence -------------------------------------------------------------


def combine_linked(linked: DataFrame, more: DataFrame) -> DataFrame:
    """Add the links of a further bucket; distinct.

    ``linked`` is distinct, and no link in it has the label of this bucket, so only ``more`` can hold copies.
    """
    return stacked(linked, _linked(more).distinct())


def bucket_tradedb(residual: DataFrame) -> DataFrame:
    """What is left gets a placeholder made of the contributor id."""
    placeholder = isni_placeholder(F.col("trade_db_contributor_id"))
    return residual.select("*", placeholder.alias("matched_isni"), F.lit(FALLBACK).alias("ref_to"))


def isni_placeholder(contributor_id: Column) -> Column:
    return F.concat(F.lit(ISNI_PLACEHOLDER_PREFIX), contributor_id.cast("string"))


def _linked(bucket: DataFrame) -> DataFrame:
    """The linked rows of a bucket, reduced to the columns of a link."""
    columns = LINK + (["delta_flag"] if "delta_flag" in bucket.columns else [])
    return bucket.filter(F.col("ref_to").isNotNull()).select(*columns)
