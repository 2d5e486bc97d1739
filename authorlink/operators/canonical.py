"""One name per author."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authorlink.functions.names import has_no_identity
from authorlink.operators.keys import lookup


def null_placeholder_names(rows: DataFrame) -> DataFrame:
    """Credits under a placeholder name lose ISNI, evidence and id."""
    nobody = has_no_identity(F.col("author_nm"))
    cleared = ["matched_isni", "ref_to", "indigo_contr_id"]
    return rows.withColumns({c: F.when(~nobody, F.col(c)) for c in cleared})


def canonical_names(rows: DataFrame, id_column: str, name_column: str) -> DataFrame:
    """Per id the most frequent name; of equals the longest, then the first in the alphabet.

    Names are counted first, and the choice is an aggregate rather than a
    window, so an author with many names is combined before the shuffle too.
    """
    named = rows.filter(F.col(id_column).isNotNull() & F.col(name_column).isNotNull())
    counted = named.groupBy(id_column, name_column).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.struct(
        (-F.col("_n")).alias("n"), (-F.length(name_column)).alias("len"), F.col(name_column).alias("name")
    )
    best = counted.groupBy(id_column).agg(F.min(rank).alias("_best"))
    return best.select(id_column, F.col("_best.name").alias("_canonical"))


def add_canonical_name(
    rows: DataFrame, names: DataFrame, id_column: str, target: str
) -> DataFrame:
    """Join the canonical name of each row's id."""
    return lookup(rows.drop(target), names, [id_column]).withColumnRenamed("_canonical", target)
