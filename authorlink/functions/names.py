"""Author names: blanking placeholders, joining name parts, normalising."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from authorlink.schemas import NAME_PARTS_BLANKED, NAMES_WITHOUT_IDENTITY, UNIDENTIFIED


def blank_placeholder(part: Column) -> Column:
    """NULL for a name part which only says that the name is missing."""
    says_nothing = reduce(Column.__or__, [part.ilike(p) for p in NAME_PARTS_BLANKED])
    return F.when(says_nothing, None).otherwise(part)


def full_name_guarded(first: Column, last: Column) -> Column:
    """Both parts joined and trimmed; NULL when both are missing."""
    first_text, last_text = F.coalesce(first, F.lit("")), F.coalesce(last, F.lit(""))
    joined = F.trim(F.concat(first_text, F.lit(" "), last_text))
    return F.when(first_text == last_text, first).otherwise(joined)


def full_name_or_unidentified(first: Column, last: Column) -> Column:
    """Both parts joined if they differ, else the one there is, else a fixed word."""
    return F.when(first != last, F.concat(first, F.lit(" "), last)).otherwise(
        F.coalesce(first, last, F.lit(UNIDENTIFIED))
    )


def full_name_strict(first: Column, last: Column) -> Column:
    """Both parts joined; NULL when either is missing."""
    return F.concat(first, F.lit(" "), last)


def normalise_name(name: Column) -> Column:
    """Upper case, without outer spaces, any run of white space as one space."""
    # Few names have what takes long to replace, and looking for it takes no time.
    broken = name.contains("\r") | name.contains("\n") | name.contains("\t")
    one_line = F.when(broken, F.translate(name, "\r\n\t", "   ")).otherwise(name)
    upper = F.trim(F.upper(one_line))
    return F.when(upper.contains("  "), F.regexp_replace(upper, " +", " ")).otherwise(upper)


def has_no_identity(name: Column) -> Column:
    """True for names which stand for nobody in particular; never NULL."""
    return F.coalesce(F.upper(name).isin(*NAMES_WITHOUT_IDENTITY), F.lit(False))
