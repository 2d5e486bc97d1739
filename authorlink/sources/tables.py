"""Reading input tables, writing results."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from authorlink import schemas


def conform(df: DataFrame, layout: T.StructType) -> DataFrame:
    """The columns of ``layout``, in its order and types; absent ones are an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout])


@dataclass(frozen=True)
class Inputs:
    """The five tables of a run."""

    trade_contributors: DataFrame
    matched_author_isbn13: DataFrame
    isni_authors: DataFrame
    isni_isbns: DataFrame
    engine_output: DataFrame

    def __post_init__(self) -> None:
        layouts = {
            "trade_contributors": schemas.FEED,
            "matched_author_isbn13": schemas.MASTER,
            "isni_authors": schemas.ISNI_AUTHORS,
            "isni_isbns": schemas.ISNI_ISBNS,
            "engine_output": schemas.ENGINE_OUTPUT,
        }
        for name, layout in layouts.items():
            object.__setattr__(self, name, conform(getattr(self, name), layout))

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str, matched: bool = True) -> Inputs:
        """Parquet tables, one folder or file per table name; before the matcher ran, without its output."""
        return cls._read(spark, lambda name: spark.read.parquet(f"{folder}/{name}"), matched)

    @classmethod
    def from_catalog(cls, spark: SparkSession, schema: str, matched: bool = True) -> Inputs:
        """Tables of a catalog schema, under the same names."""
        return cls._read(spark, lambda name: spark.table(f"{schema}.{name}"), matched)

    @classmethod
    def _read(cls, spark: SparkSession, table: Callable[[str], DataFrame], matched: bool) -> Inputs:
        names = [name for name in cls.__dataclass_fields__ if matched or name != "engine_output"]
        missing = {} if matched else {"engine_output": spark.createDataFrame([], schemas.ENGINE_OUTPUT)}
        return cls(**{name: table(name) for name in names}, **missing)


def write_snapshot(master: DataFrame, path: str) -> DataFrame:
    """Write a new version of the master; an existing path is an error, for it may be the one being read."""
    master.write.mode("errorifexists").parquet(path)
    return master.sparkSession.read.schema(master.schema).parquet(path)


def publish_stage(stage: DataFrame, path: str) -> DataFrame:
    """Replace the staging table."""
    stage.write.mode("overwrite").parquet(path)
    return stage.sparkSession.read.schema(stage.schema).parquet(path)
