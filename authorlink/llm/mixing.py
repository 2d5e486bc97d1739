"""Mixing sources to target weights by repetition rates and hash-seeded Bernoulli copies.

Tokens are summed per source, with a partial sum in every task. A source's rate
is its target divided by its tokens. Each document is taken ``floor(rate)``
times, plus once more if a hash of its id, read as a fraction of one, is below
the fraction of the rate. The decision needs nothing but the row and its
source's rate, so a hot source costs no more than another: the rates, one row
for each source, are joined to the documents, and documents are not grouped.

Defined cases. A null text has size 0 and is taken like any other, without
words. Null sources are one source, last in order. A null id is hashed like an
empty one. Repeated rows (the same id) share one draw. An empty table gives an
empty result. If all sizes are 0, all targets are 0. Further columns pass
through ``mix``, but for the names of the columns it adds, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authorlink.llm import common
from authorlink.operators.ids import number_densely
from authorlink.sources.workspace import Workspace

#: Weights in turn for the sources by name, words to take as a share of all, greatest repetition.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix-1"


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` of documents with ``source`` and ``size``.

    Targets follow the weights up to ``most`` times the source's size; what a
    source cannot take is shared out among the others until none is above. Each
    round is one sum over the sources and fixes at least one more of them.
    """
    totals = common.written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    named = totals.where("source IS NOT NULL")
    places = number_densely(named.select("source"), "source", "_place", Workspace(sized.sparkSession))
    last = totals.where("source IS NULL").withColumn("_place", F.lit(named.count() + 1).cast("long"))
    ranked = named.join(places, "source").unionByName(last)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int"))
    known = common.written(ranked.withColumn("weight", weight.cast("double")).drop("_place"), "source-weights")
    cap = F.col("source_size") * most
    total = float(known.agg(F.sum("source_size")).first()[0] or 0)
    level, rest, free = -1.0, 0.0, 1.0
    while True:
        below = cap <= F.lit(level) * F.col("weight")
        capped, open_weight = known.agg(F.sum(F.when(below, cap)), F.sum(F.when(~below, F.col("weight")))).first()
        rest, free = total * share - float(capped or 0), float(open_weight or 0)
        if not free or rest / free <= level:
            break
        level = rest / free
    if not free:
        return known.select("source", "source_size", cap.cast("double").alias("target"))
    open_target = F.lit(rest) * F.col("weight") / F.lit(free)
    return known.select("source", "source_size", F.least(cap.cast("double"), open_target).alias("target"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A fraction in [0, 1) that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The documents with ``size``, ``source_size``, ``target`` and ``copies``, the times each is taken."""
    sized = docs.drop("size", "source_size", "target", "copies").withColumn("size", common.words_in(F.col("text")))
    targets = source_targets(sized.select("source", "size"), weights, share, most).withColumnRenamed("source", "_source")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    extra = F.when(draw(F.col("doc_id"), seed) < rate - whole, F.lit(1)).otherwise(F.lit(0))
    return joined.withColumn("copies", (whole + extra).cast("long"))


def emitted(mixed: DataFrame) -> DataFrame:
    """Each document of ``mix`` as often as it is taken, without the added columns."""
    times = mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return times.drop("size", "source_size", "target", "copies", "_copy")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


#: The water level is found at once here: sources by cap over weight, and the first that stays below its cap.
OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS DOUBLE) AS weight FROM totals),
ordered AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
      - 2.0 * coalesce(sum(source_size) OVER (ORDER BY 2.0 * source_size / weight, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (ORDER BY 2.0 * source_size / weight, encode(source) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM ranked),
level AS (
  SELECT rest, free FROM ordered WHERE rest / free <= 2.0 * source_size / weight
  ORDER BY 2.0 * source_size / weight, encode(source) LIMIT 1),
targets AS (
  SELECT source, source_size, least(2.0 * source_size, rest * weight / free) AS target FROM ranked, level),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
  size * (CAST(floor(rate) AS BIGINT) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM rated
"""
