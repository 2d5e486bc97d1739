"""Tables in buckets of a key: joins on it, or on more columns, leave their rows where they are.

A table in buckets is parquet files like others, whose names tell their bucket; the session's
catalog only has to know so while it is read. ``SETTING`` lets joins on more columns than
those of the buckets use them, and opening a table sets it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

SETTING = ("spark.sql.requireAllClusterKeysForCoPartition", "false")
#: What is written for later steps, mostly hashes and names.
COMPRESSION = ("compression", "zstd")
#: A task has the rows of one bucket, so it need not sort them by bucket to write them; one that has more buckets does.
WRITERS = ("spark.sql.maxConcurrentOutputFileWriters", "2")
#: Rows that a bucket of a run's own table is meant for, and the least number of buckets.
ROWS, LEAST = 500_000, 8


def buckets_for(rows: int) -> int:
    """How many buckets a table gets, so that none grows with the table."""
    return max(LEAST, -(-rows // ROWS))


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int, dealt: bool = False) -> None:
    """Write ``df`` to a new ``path``, in ``buckets`` buckets of ``keys``.

    What is made of a table in the same buckets lies in them already and is not moved first, nor is what
    the caller has ``dealt`` to them.
    """
    if not dealt and buckets_of(df, keys) != buckets:
        df = df.repartition(buckets, *keys)  # no second shuffle where this is how the rows were dealt
    name = f"authorlink_{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(WRITERS[0], None)
    try:
        conf.set(*WRITERS)
        df.write.bucketBy(buckets, *keys).option("path", path).option(*COMPRESSION).format("parquet").saveAsTable(name)
    finally:
        conf.unset(WRITERS[0]) if before is None else conf.set(WRITERS[0], before)
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay


class Buckets:
    """Opens tables in buckets; ``close`` makes the catalog forget them."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._names: list[str] = []

    def open(self, path: str, columns: str, keys: Sequence[str], buckets: int) -> DataFrame:
        """The table under ``path``, with ``columns`` as DDL."""
        self._spark.conf.set(*SETTING)
        name = f"authorlink_{uuid.uuid4().hex}"
        place = path.replace("'", "\\'")
        self._spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(keys)}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        self._names.append(name)
        return self._spark.table(name)

    def close(self) -> None:
        for name in self._names:
            self._spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._names.clear()


def buckets_of(df: DataFrame, keys: Sequence[str]) -> int | None:
    """In how many buckets of ``keys`` the one table lies that ``df`` reads first; None if in none."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    leaf = leaves.apply(0) if leaves.size() else None
    if leaf is None or leaf.nodeName() != "LogicalRelation" or leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return None
    spec = leaf.relation().bucketSpec()
    if spec.isEmpty():
        return None
    columns = spec.get().bucketColumnNames()
    named = [columns.apply(i) for i in range(columns.size())]
    return spec.get().numBuckets() if named == list(keys) else None
