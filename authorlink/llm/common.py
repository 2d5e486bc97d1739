"""What several operators of the subpackage share."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authorlink.sources.workspace import Workspace

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{table}.parquet"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder of ``spark.checkpoint.dir``: cuts lineage, survives lost executors."""
    return Workspace(df.sparkSession).stage(df, name)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_in(text: Column) -> Column:
    """Number of words of a text; 0 where it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def tasks_for(rows: int, per_task: int) -> int:
    return max(1, -(-rows // per_task))


#: A key with one in so many of the rows is hot; there can be no more hot keys than this.
HOT_KEYS = 10_000


def looked_up(rows: DataFrame, keyed: DataFrame, on: Sequence[str], n: str, total: int | None = None, how: str = "left") -> DataFrame:
    """``rows`` with the further columns of ``keyed``, which has each key once and in ``n`` how many rows have it.

    Hot keys are broadcast, at most ``HOT_KEYS`` of them, and their rows stay where they are; the other
    rows meet theirs by a shuffle. NULL is a key like others. Both tables are read twice. ``total`` is
    the sum of ``n``, or else the number of rows.
    """
    total = rows.count() if total is None else total
    named = keyed.withColumnsRenamed({c: f"_key_{i}" for i, c in enumerate(on)})
    added = [c for c in keyed.columns if c not in on and c != n]
    same = reduce(Column.__and__, [rows[c].eqNullSafe(named[f"_key_{i}"]) for i, c in enumerate(on)])
    is_hot = F.col(n) * HOT_KEYS >= F.lit(total)
    hot, others = F.broadcast(named.where(is_hot)), named.where(~is_hot)
    columns = [*(rows[c] for c in rows.columns), *added]
    met = rows.join(hot, same, "inner").select(*columns)
    return met.unionByName(rows.join(hot, same, "left_anti").join(others, same, how).select(*columns))
