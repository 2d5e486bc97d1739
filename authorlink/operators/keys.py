"""Joins on keys that may be missing, repeated or hot.

The joins are plain ones, so that one partitioning can serve several of them: tables in
buckets (``authorlink.sources.buckets``) meet without moving. The right side of a test for
partners is made distinct, in every task before it moves, so a key that is hot there is a row a
task. Where the left side may be hot, ``split`` lets AQE split it (``authorlink.job.SETTINGS``
makes it do so in front of other steps as well). Where the sides lie in the same buckets, ``hashed``
keeps the right side's rows of a bucket in memory instead of sorting both sides; there each key is one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HIT = "_hit"


def any_null(on: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in on])


def no_null(on: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in on])


def nulls_last(columns: Sequence[str]) -> list[Column]:
    """Fields of a struct that orders like ``columns`` ascending, NULL after all values."""
    return [field for c in columns for field in (F.col(c).isNull(), F.col(c))]


def stacked(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union by name; of tables in the same buckets it lies in them too.

    Spark sees so only if the columns of ``first`` are the union's own, so they are named anew.
    """
    return first.select(*[F.col(c).alias(c) for c in first.columns]).unionByName(second)


def _check_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> None:
    for c in on:
        if left.schema[c].dataType != right.schema[c].dataType:
            raise TypeError(f"key {c!r} has different types on the two sides of a join")


def _held(right: DataFrame, hashed: bool) -> DataFrame:
    return right.hint("shuffle_hash") if hashed else right


def _join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, hashed: bool = False) -> DataFrame:
    _check_types(left, right, on)
    joined = left.join(_held(right, hashed), list(on), how)
    return joined.select(*left.columns, *[c for c in right.columns if c not in on])


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str], hashed: bool = False) -> DataFrame:
    """Left join; the columns of ``right`` follow those of ``left``."""
    return _join(left, right, on, "left", hashed)


def match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join, with columns as in ``lookup``."""
    return _join(left, right, on, "inner")


def _partners(left: DataFrame, right: DataFrame, on: Sequence[str], split: bool) -> DataFrame:
    """The complete keys of ``right``, each once.

    One shuffle serves to make them distinct and to join them, but AQE then leaves the join
    alone. With ``split`` the distinct keys are shuffled a second time, and it can split ``left``.
    """
    _check_types(left, right, on)
    partners = right.filter(no_null(on)).select(*on)
    if not split:
        return partners.distinct()
    part = F.pmod(F.xxhash64(*on), F.lit(1 << 20))
    return partners.withColumn("_part", part).distinct().drop("_part")


def exclude(
    left: DataFrame, right: DataFrame, on: Sequence[str], split: bool = False, hashed: bool = False
) -> DataFrame:
    """Rows of ``left`` without a partner (NOT EXISTS: a missing key has none)."""
    if hashed:
        # Nothing moves, and in memory such a join keeps one row a key.
        _check_types(left, right, on)
        partners = _held(right.filter(no_null(on)).select(*on), True)
    else:
        partners = _partners(left, right, on, split)
    return left.join(partners, list(on), "left_anti").select(*left.columns)


def keep(left: DataFrame, right: DataFrame, on: Sequence[str], split: bool = False) -> DataFrame:
    """Rows of ``left`` with a partner."""
    return left.join(_partners(left, right, on, split), list(on), "left_semi").select(*left.columns)


def lookup_flag(
    left: DataFrame, right: DataFrame, on: Sequence[str], flag: str, split: bool = False, hashed: bool = False
) -> DataFrame:
    """Add a boolean: does the row have a partner. Never repeats rows of ``left``."""
    partners = _partners(left, right, on, split).withColumn(flag, F.lit(True))
    found = left.join(_held(partners, hashed), list(on), "left")
    return found.select(*left.columns, F.col(flag).isNotNull().alias(flag))


def one_per_key(rows: DataFrame, on: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``; an aggregate, so hot keys combine before the shuffle."""
    rest = [c for c in rows.columns if c not in on and c not in order]
    ordered = F.struct(
        *[f.alias(f"_{i}") for i, f in enumerate(nulls_last([*order, *rest]))]
    )
    picked = rows.groupBy(*on).agg(F.min(ordered).alias("_first"))
    values = {c: F.col(f"_first._{2 * i + 1}") for i, c in enumerate([*order, *rest])}
    return picked.select(*[values[c].alias(c) if c in values else F.col(c) for c in rows.columns])


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    values: dict[str, Column],
    hashed: bool = False,
) -> DataFrame:
    """Overwrite columns of ``target`` rows whose key is in ``source``.

    ``source`` holds each key once; ``values`` may use its columns.
    """
    hit = lookup(target, source.withColumn(_HIT, F.lit(True)), on, hashed)
    return hit.select(
        *[
            F.when(F.col(_HIT), values[c].cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in values
            else F.col(c)
            for c in target.columns
        ]
    )


def _not_in_facts(keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row: are there any keys, and is one of them incomplete."""
    return keys.agg(
        (F.count(F.lit(1)) > 0).alias("_some"),
        F.coalesce(F.bool_or(any_null(on)), F.lit(False)).alias("_gap"),
    )


def residual_after(
    rows: DataFrame,
    linked: DataFrame,
    on: Sequence[str],
    null_safe: bool = False,
    split: bool = True,
    hashed: bool = False,
) -> DataFrame:
    """Rows whose key is NOT IN the keys of ``linked``, by SQL's three-valued logic.

    An incomplete key in ``linked`` leaves no rows, an incomplete key in ``rows``
    drops the row, and an empty ``linked`` keeps everything. ``null_safe`` takes
    NULL as a value like any other instead. Tables in the same buckets of a part of the key
    meet in place without ``split``, and may be ``hashed``.
    """
    if null_safe:
        partners = linked.select(*on).distinct()
        same = reduce(Column.__and__, [rows[c].eqNullSafe(partners[c]) for c in on])
        return rows.join(partners, same, "left_anti")
    passed = ~F.col("_some") | (~F.col("_gap") & no_null(on))
    facts = F.broadcast(_not_in_facts(linked.select(*on), on))  # one row
    left = rows.crossJoin(facts).filter(passed).select(*rows.columns)
    return exclude(left, linked, on, split, hashed)


def mark_taken(rows: DataFrame, on: Sequence[str], taken: str, mark: str = "ref_to") -> DataFrame:
    """Add a boolean: is the row, or another one of its key, linked."""
    of_key = Window.partitionBy(*on)
    return rows.withColumn(taken, F.max(F.col(mark).isNotNull()).over(of_key))


def residual_marked(
    rows: DataFrame, on: Sequence[str], null_safe: bool = False, taken: str | None = None, mark: str = "ref_to"
) -> DataFrame:
    """``residual_after`` of a written table and its own linked rows, without a join.

    ``taken`` names the column of ``mark_taken``; without it equal keys must share
    their link, as when the link was looked up by columns of the key. What the linked keys
    look like is read in a pass of its own, of which one row reaches the driver.
    """
    unlinked = rows.filter(F.col(mark).isNull())
    some, gap = (False, False) if null_safe else _not_in_facts(rows.filter(F.col(mark).isNotNull()), on).first()
    if some:
        unlinked = unlinked.filter(F.lit(False) if gap else no_null(on))
    return unlinked.filter(~F.col(taken)).drop(taken) if taken else unlinked


def singletons(rows: DataFrame, on: Sequence[str], copies: str | None = None) -> DataFrame:
    """Rows whose complete key occurs once; ``copies`` counts a row several times.

    The value of a column in a group of one row is its minimum, so one
    aggregate both counts and returns the row.
    """
    rest = [c for c in rows.columns if c not in on]
    n = F.sum(copies) if copies else F.count(F.lit(1))
    grouped = rows.filter(no_null(on)).groupBy(*on).agg(n.alias("_n"), *[F.min(c).alias(c) for c in rest])
    return grouped.filter(F.col("_n") == 1).select(*rows.columns)


def collapse_copies(rows: DataFrame, copies: str) -> DataFrame:
    """Exact copies as one row with their number, combined before the shuffle."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(copies))
