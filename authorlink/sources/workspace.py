"""Intermediate tables of a run."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from authorlink.sources.buckets import COMPRESSION, Buckets, buckets_for, buckets_of, write_buckets

_SETTING = "spark.checkpoint.dir"


class Workspace:
    """A folder for tables that several steps of one run read.

    Writing them cuts the lineage and survives the loss of executors. The folder
    lies in ``folder``, or else in the shared one the session names in ``spark.checkpoint.dir``; only a
    session in local mode may go without either. Results of a run read
    these tables, so keep them until the results are written, then ``drop`` them.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self._spark = spark
        self._seen: Counter[str] = Counter()
        self._tables = Buckets(spark)
        self.path = f"{(folder or _shared_folder(spark)).rstrip('/')}/authorlink-{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written table."""
        path = self._next(name)
        df.write.option(*COMPRESSION).parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def stage_in_buckets(self, df: DataFrame, name: str, keys: Sequence[str], buckets: int, dealt: bool = False) -> DataFrame:
        """``stage`` for a table that meets another one in the same buckets."""
        path = self._next(name)
        write_buckets(df, path, keys, buckets, dealt)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        return self._tables.open(path, columns, keys, buckets)

    def in_buckets(self, df: DataFrame, name: str, keys: Sequence[str], rows: int = 0) -> DataFrame:
        """``df`` itself if it lies in buckets of ``keys``, else a copy that does, in as many as its rows call for.

        ``rows`` is the number of rows of a larger table that will be dealt like it.
        """
        return df if buckets_of(df, keys) else self.stage_in_buckets(df, name, keys, buckets_for(max(rows, df.count())))

    def stage_dealt(self, df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
        """``stage_in_buckets`` for what was made of tables in the same buckets: only what left them on the way is moved."""
        return self.stage_in_buckets(df.repartition(buckets, *keys), name, keys, buckets, dealt=True)

    def _next(self, name: str) -> str:
        self._seen[name] += 1
        return f"{self.path}/{name}-{self._seen[name]}"

    def drop(self) -> None:
        """Delete the tables of this run."""
        self._tables.close()
        jvm = self._spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="authorlink-")
