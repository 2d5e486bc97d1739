"""Input tables derived from the supplied ``lineitem`` and ``supplier``.

Every line item is a credit of the feed. The master is an earlier, smaller
delivery of the same credits with other ids, evidence and name variants, so
that new, changed and unchanged credits all occur. The ``odd`` tables add what is rare: names
with white space, names that stand for nobody, incomplete slots, placeholders in capitals and
several names on one merge key.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authorlink import schemas as S
from authorlink.functions.hashing import change_hash
from authorlink.functions.names import full_name_or_unidentified
from authorlink.sources.tables import Inputs, conform
from authorlink.sources.workspace import Workspace


def _first_name(odd: bool) -> Column:
    k = F.col("k")
    rare = [(k % 31 == 0, F.lit("\tMary  Ann ")), (k % 41 == 0, F.lit("Anonymous")), (k % 43 == 0, F.lit(None))]
    usual = [(k % 17 == 0, F.lit("Unknown")), (k % 19 == 0, F.lit("(Not Supplied)")), (k % 23 == 0, F.lit(None))]
    return _first_case([*(rare if odd else []), *usual], F.concat(F.lit("F"), (k % 2).cast("string")))


def _last_name(odd: bool) -> Column:
    k = F.col("k")
    same = F.concat(F.lit("F"), (k % 2).cast("string"))
    rare = [(k % 31 == 0, F.lit("O'Neil \r\n Jr")), (k % 41 == 0, F.lit(None)), (k % 43 == 0, F.lit("unknown"))]
    usual = [(k % 17 == 0, F.lit("Author")), (k % 29 == 0, F.lit(None)), (k % 7 == 0, same)]
    return _first_case([*(rare if odd else []), *usual], F.concat(F.lit("L"), (k % F.col("m")).cast("string")))


def _first_case(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    (condition, value), *rest = cases
    chosen = F.when(condition, value)
    for condition, value in rest:
        chosen = chosen.when(condition, value)
    return chosen.otherwise(otherwise)


def _isni(k: Column) -> Column:
    return F.concat(F.lit("0000"), F.lpad(k.cast("string"), 12, "0"))


class Fixtures:
    """The derived tables for one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, odd: bool = False):
        self._spark = spark
        self._dir = sf_dir
        self._odd = odd

    def _read(self, table: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{table}.parquet")

    @cached_property
    def _suppliers(self) -> DataFrame:
        return self._read("supplier").select(F.col("s_suppkey").alias("k"))

    def _named(self, rows: DataFrame) -> DataFrame:
        """Add the name parts and full name of contributor ``k``."""
        size = self._suppliers.agg(F.expr("greatest(2, count(*) * 18 div 25)").alias("m"))
        named = rows.crossJoin(F.broadcast(size)).withColumns({"fn": _first_name(self._odd), "ln": _last_name(self._odd)})
        return named.withColumn("nm", full_name_or_unidentified(F.col("fn"), F.col("ln"))).drop("m")

    @cached_property
    def _lines(self) -> DataFrame:
        lines = self._read("lineitem").select(
            F.col("l_suppkey").alias("k"),
            "l_orderkey",
            "l_partkey",
            F.lpad(F.col("l_orderkey").cast("string"), 13, "0").alias("isbn13"),
            F.col("l_returnflag").alias("role"),
            F.col("l_linenumber").cast("bigint").alias("position"),
        )
        if self._odd:
            # Of contributors that nothing links: else the later buckets would be empty by the rules of NOT IN.
            loose, part = (F.col("k") % 2 == 1) & (F.col("k") % 3 != 0), F.col("l_partkey")
            gaps = {"isbn13": 83, "role": 89, "position": 97}
            lines = lines.withColumns({c: F.when(~(loose & (part % n == 0)), F.col(c)) for c, n in gaps.items()})
        return self._named(lines)

    @cached_property
    def trade_contributors(self) -> DataFrame:
        named = F.col("l_partkey") % 101 != 0
        return self._lines.select(
            F.col("k").alias("trade_db_contributor_id"),
            "isbn13",
            F.col("role").alias("contributor_role"),
            F.col("position").alias("contributor_order"),
            F.when(named, F.col("fn")).alias("contributor_first_name"),
            F.when(named, F.col("ln")).alias("contributor_last_name"),
        )

    @cached_property
    def _facts(self) -> DataFrame:
        """Every line as an author known earlier, in the few values that decide all others.

        Different facts of a book make different rows in ``_worded``, so copies can leave here, while rows are short.
        """
        k, order = F.col("k"), F.col("l_orderkey")
        moved, variant = (k % 12 == 0) & (order % 50 == 0), F.when(order % 10 == 1, 1).when(order % 10 == 2, 2).otherwise(0)
        if self._odd:
            moved, variant = moved & (k % 47 != 0), F.when(F.col("l_partkey") % 5 == 0, 3).otherwise(variant)
        return self._lines.select(
            "l_orderkey",
            "isbn13",
            (k + F.when((k % 15 == 0) & (order % 7 == 3), 5000).otherwise(1000)).alias("author_id"),
            "k",
            "role",
            "position",
            F.coalesce(moved, F.lit(False)).alias("moved"),
            variant.alias("variant"),
        )

    def _worded(self, facts: DataFrame) -> DataFrame:
        """Facts with the names, ISNI and evidence that they stand for."""
        k = F.col("k")
        variant = (
            F.when(F.col("variant") == 1, F.concat(F.upper("nm"), F.lit(" ")))
            .when(F.col("variant") == 2, F.concat("nm", F.lit(" Jr")))
            .when(F.col("variant") == 3, F.concat("nm", F.lit(" II")))
            .otherwise(F.col("nm"))
        )
        isni = F.when(k % 3 == 0, F.when(F.col("moved"), _isni(k + 1)).otherwise(_isni(k)))
        if self._odd:
            capital = F.concat(F.lit(S.ISNI_PLACEHOLDER_PREFIX.upper()), k.cast("string"))
            isni = F.when(k % 47 == 0, capital).otherwise(isni)
        source = (
            F.when(k % 9 == 0, S.BY_CONTRIBUTOR).when(k % 3 == 0, S.BY_NAME).otherwise(F.lit(S.FALLBACK))
        )
        return self._named(facts).withColumns({"isni": isni, "variant": variant, "source": source})

    @cached_property
    def matched_author_isbn13(self) -> DataFrame:
        k, order = F.col("k"), F.col("l_orderkey")
        row_hash = change_hash(k, F.col("author_id"), F.col("nm"), F.col("isni"))
        # The master lacks a part of the books and the later positions, so that credits are new.
        earlier = self._facts.filter((order % 10 < 7) & (F.col("position") <= 5))
        # Nearly all rows differ, so combining them before they move would only fill the tasks.
        earlier = earlier.withColumn("hashed", order % 10 != 5).drop("l_orderkey").repartition("isbn13", "role", "position")
        rows = self._worded(earlier.distinct()).select(
            "isbn13",
            F.col("author_id").alias("indigo_author_id"),
            k.alias("trade_db_contributor_id"),
            F.col("role").alias("trade_db_contributor_role"),
            F.col("position").alias("trade_db_contributor_order"),
            F.col("isni").alias("matched_isni"),
            F.col("nm").alias("normailized_author_name"),
            F.col("variant").alias("trade_db_author_name"),
            F.col("source").alias("id_source"),
            F.when(F.col("hashed"), row_hash).alias("dmc_sync_hash_id"),
            F.lit(True).alias("dmc_synced"),
            F.lit(S.TRANSFORMATION_ID).alias("transformation_id"),
            F.lit(None).alias("etl_updated_date"),
        )
        return conform(rows, S.MASTER)

    @cached_property
    def book_ref_prior(self) -> DataFrame:
        """The delivery before the master: placeholders still in place, some rows unresolved, not distinct."""
        k, order = F.col("k"), F.col("l_orderkey")
        return self._worded(self._facts).select(
            "isbn13",
            F.when(order % 10 != 6, F.col("author_id")).alias("indigo_contr_id"),
            k.alias("trade_db_contributor_id"),
            F.col("role").alias("contributor_role"),
            F.col("position").alias("contributor_order"),
            F.coalesce("isni", F.concat(F.lit(S.ISNI_PLACEHOLDER_PREFIX), k.cast("string"))).alias("matched_isni"),
            F.when(F.col("nm") != S.UNIDENTIFIED, F.col("nm")).alias("indigo_contr_nm"),
            F.col("variant").alias("author_nm"),
            F.col("source").alias("ref_to"),
        )

    @cached_property
    def _holders(self) -> DataFrame:
        k = F.col("k")
        holders = self._suppliers.filter(k % 2 == 0)
        return self._named(holders).withColumn("isni", _isni(k))

    @cached_property
    def isni_authors(self) -> DataFrame:
        return self._holders.select("isni", F.col("fn").alias("first_name"), F.col("ln").alias("last_name"))

    @cached_property
    def isni_isbns(self) -> DataFrame:
        k, order = F.col("k"), F.col("l_orderkey")
        books = self._lines.filter((k % 2 == 0) & (order % 3 == 0))
        return books.select("isbn13", _isni(k).alias("isni")).distinct()

    @cached_property
    def engine_output(self) -> DataFrame:
        holders = self._holders.filter(F.col("nm") != S.UNIDENTIFIED).select("k", "nm", "isni")
        names = holders.groupBy("nm").agg((F.count_distinct("isni") > 1).alias("several"))
        found = holders.join(names, "nm").filter(~(F.col("several") & (F.col("k") % 10 == 4)))
        return found.select(
            F.col("nm").alias("author_nm"),
            F.col("isni").alias("matched_isni"),
            F.when(F.col("several"), S.AMBIGUOUS_FLAG).alias("dup_name_flag"),
        )

    def inputs(self, workspace: Workspace | None = None) -> Inputs:
        """All tables of a run; written first if there is a workspace, as real tables would be."""
        tables = {name: getattr(self, name) for name in Inputs.__dataclass_fields__}
        if workspace:
            tables = {name: workspace.stage(df, name) for name, df in tables.items()}
        return Inputs(**tables)
