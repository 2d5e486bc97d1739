"""Exact top-k search by inner product with a uniform threshold, in three phases.

The components of the vectors are cut into ``lists`` parts of equal length. A
row's score for a query is the sum of its partial scores, one in every list.

1. Of each block of rows, every list's ``k`` best partial scores for a query are
   gathered, with the rows' whole scores. The k-th best whole score among them,
   over all blocks, is a score that k rows reach: a safe cutoff ``tau``.
2. A row with a score of ``tau`` or more has a partial score of ``tau / lists`` or
   more in some list. The entries from that threshold on are collected; no other
   row can be among the best.
3. The missing parts of the collected rows' scores are resolved exactly, and the
   best ``k`` are kept.

Queries and rows are packed into blocks of bounded size, each component in as few
bytes as the block's largest needs, and meet in a grid: rows go in spans of up to
``SPAN`` blocks, and the pair (query block, span) is the key of an equi-join by a
shuffle. It is never a broadcast: either side is copied for each block of the other,
so what the copies take grows with the square of the data, whatever the size of the
tables they are made of. A task holds one block of either side at a time, and keeps
at most the best ``k`` rows a query for the span it is in; Spark merges those of the
spans. The cutoffs go to the query blocks by a join as well, since their number grows
with the data.

Scores are whole numbers. Products are summed in floating point of the least
precision in which no sum can round (up to 2**24 or 2**53), and with Python's integers beyond.

Defined cases. Vectors that are null, or hold a null or non-finite component, or
are empty, take no part; neither do those of another length than the most
frequent one (the smaller at a tie), or rows without id. An empty table gives an
empty result. Of equal scores the smaller id comes first. Repeated rows (the same
id) are each a candidate, but never for a query with their id; a query id that is
repeated is asked once, with its smallest vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from authorlink.llm import common

K = 20
LISTS = 2
#: Rows and queries in a block, and most row blocks in a span. A pair of blocks needs about 8 bytes times their product, a
#: slice of queries at a time.
ROW_BLOCK, QUERY_BLOCK, SPAN, SLICE = 4096, 1024, 16, 128
#: Pairs of blocks that are dealt out one by one before any are dealt out as spans, and most tasks of a grid.
PAIRS, TASKS = 256, 20_000

_HITS = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, factor: int = 64) -> DataFrame:
    """``(vec_id, v)``: components times ``factor``, rounded down, of the vectors that take part."""
    usable = F.col("embedding").isNotNull() & F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * factor) < 2.0**62),
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * factor).cast("long"))
    return vectors.where(usable & F.col("vec_id").isNotNull()).select("vec_id", whole.alias("v")).where(F.size("v") > 0)


def _packed(rows: DataFrame, block: Column, key: str) -> DataFrame:
    """Blocks as ``(key, ids, width, vs)``: ids of 8 bytes and components of ``width`` bytes, end to end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, ids, vectors = None, [], []
        for batch in batches:
            keys = batch.column("block").to_numpy()
            starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
                if of != keys[a] and ids:
                    yield packed(of, ids, vectors)
                    ids, vectors = [], []
                of = keys[a]
                ids.append(batch.column("vec_id")[a:b].to_numpy())
                vectors.append(batch.column("v")[a:b].flatten().to_numpy())
        if ids:
            yield packed(of, ids, vectors)

    def packed(of: int, ids: list[np.ndarray], vectors: list[np.ndarray]) -> pa.RecordBatch:
        whole = np.concatenate(vectors)
        low, high = int(whole.min()), int(whole.max())
        width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
        columns = [pa.array([of], pa.int32()), pa.array([np.concatenate(ids).tobytes()], pa.binary())]
        columns += [pa.array([width], pa.int32()), pa.array([whole.astype(f"i{width}").tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, [key, "ids", "width", "vs"])

    dealt = rows.select(block.alias("block"), "vec_id", "v").repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, f"{key} int, ids binary, width int, vs binary")


def _grid(queries: DataFrame, rows: DataFrame, query_blocks: int, row_blocks: int, extra: list[str]) -> DataFrame:
    """Every query block with every row block, those of a span one after the other, by an equi-join on (query block, span)."""
    spans = common.tasks_for(row_blocks, min(SPAN, common.tasks_for(query_blocks * row_blocks, PAIRS)))
    shards = F.explode(F.sequence(F.lit(0), F.lit(spans - 1)))
    left = queries.select("q", *(F.col(c).alias(f"asked_{c}") for c in ("ids", "width", "vs")), *extra, shards.alias("span"))
    parts = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    right = rows.select(F.pmod("r", F.lit(spans)).alias("span"), *(F.col(c).alias(f"held_{c}") for c in ("ids", "width", "vs")), parts.alias("q"))
    # Sizes of tables that grow in the plan are not known to it: they would be broadcast.
    left, right = (side.repartition(min(query_blocks * spans, TASKS), "q", "span") for side in (left, right))
    return left.hint("merge").join(right, ["q", "span"])


def _matrix(row: dict, side: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{side}_ids"], np.int64)
    return ids, np.frombuffer(row[f"{side}_vs"], f"i{row[f'{side}_width']}").reshape(len(ids), -1)


def _partials(asked: np.ndarray, held: np.ndarray, lists: int) -> list[np.ndarray]:
    """Partial scores by list: exact in floating point, or else as Python integers."""
    dims = asked.shape[1]
    most = float(np.abs(asked.astype(float)).max()) * float(np.abs(held.astype(float)).max()) * dims
    kind = np.float32 if most < 2.0**24 else np.float64 if most < 2.0**53 else object
    cuts = np.linspace(0, dims, min(lists, dims) + 1).astype(int)
    return [asked[:, a:b].astype(kind) @ held[:, a:b].T.astype(kind) for a, b in zip(cuts[:-1], cuts[1:])]


def _best(at: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of entries (query, id, score) the ``k`` highest scores of each query, ties to the smaller id."""
    order = np.lexsort((ids, ~scores, at))
    at, ids, scores = at[order], ids[order], scores[order]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    best = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at))) < k
    return at[best], ids[best], scores[best]


def _phase(k: int, lists: int, chosen):
    """The best ``k`` rows a query of each span, of the entries that ``chosen(parts, total, taus)`` marks in a pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, found = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if of != (row["q"], row["span"]):
                    if of:
                        yield hits(query_ids, *found)
                    of, found = (row["q"], row["span"]), [np.zeros(0, np.int64)] * 3
                    query_ids, asked = _matrix(row, "asked")
                    cutoffs = {x["query_id"]: x["tau"] for x in row.get("cutoffs", ())}
                found = met(query_ids, asked, cutoffs, *_matrix(row, "held"), found)
        if of:
            yield hits(query_ids, *found)

    def met(query_ids: np.ndarray, asked: np.ndarray, cutoffs: dict, ids: np.ndarray, held: np.ndarray, found: list) -> list:
        entries = [found]
        for start in range(0, len(query_ids), SLICE):
            some = query_ids[start : start + SLICE]
            parts = _partials(asked[start : start + SLICE], held, lists)
            others = some[:, None] != ids
            marked = chosen(parts, others, [cutoffs.get(q) for q in some.tolist()])
            at, place = np.nonzero(marked & others)
            scores = sum(part[at, place] for part in parts).astype(np.int64)
            entries.append(_best(at + start, ids[place], scores, k))
        return list(_best(*(np.concatenate(x) for x in zip(*entries)), k))

    def hits(query_ids: np.ndarray, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (query_ids[at], ids, scores)], ["query_id", "vec_id", "score"])

    return run


def _gather(k: int):
    """Phase 1: a block's best partial scores of every list; where parts tie, more than ``k``."""

    def chosen(parts: list[np.ndarray], others: np.ndarray, _: list) -> np.ndarray:
        if parts[0].dtype == object or others.shape[1] <= 4 * k:
            return others
        marked = np.zeros(others.shape, bool)
        for part in parts:
            # A query's own row is among no best scores.
            part = np.where(others, part, part.dtype.type(-np.inf))
            marked |= part >= np.partition(part, -k, axis=1)[:, -k, None]
        return marked

    return chosen


def _resolve(parts: list[np.ndarray], others: np.ndarray, taus: list) -> np.ndarray:
    """Phases 2 and 3: entries from the threshold on, of which those whose whole score reaches the cutoff."""
    known = np.array([tau is not None for tau in taus])
    kind = parts[0].dtype
    # In whole numbers: some part times their number is not below tau.
    least = np.array([0 if tau is None else -((-tau) // len(parts)) for tau in taus], kind)[:, None]
    entries = np.logical_or.reduce([part >= least for part in parts]).astype(bool)
    at, place = np.nonzero(entries & known[:, None])
    cutoffs = np.array([0 if tau is None else tau for tau in taus], kind)
    reached = (sum(part[at, place] for part in parts) >= cutoffs[at]).astype(bool)
    marked = others & ~known[:, None]
    marked[at[reached], place[reached]] = True
    return marked


def top_k(queries: DataFrame, rows: DataFrame, k: int = K, lists: int = LISTS) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of queries and rows ``(vec_id, v)`` with whole components."""
    rows = common.written(rows, "vectors")
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    length = lengths["n"] if lengths else 0
    rows = rows.where(F.size("v") == length)
    asked = queries.where(F.size("v") == length).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = common.written(asked, "queries")
    n_rows, n_queries = rows.count(), asked.count()
    row_blocks, query_blocks = common.tasks_for(n_rows, ROW_BLOCK), common.tasks_for(n_queries, QUERY_BLOCK)
    row_block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(row_blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")
    held = common.written(_packed(rows, row_block, "r"), "row-blocks")
    packed = common.written(_packed(asked, query_block, "q"), "query-blocks")

    gathered = _grid(packed, held, query_blocks, row_blocks, []).mapInArrow(_phase(k, lists, _gather(k)), _HITS)
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    first = gathered.withColumn("rank", ranked).where(F.col("rank") == k)
    cutoffs = common.written(first.select("query_id", F.col("score").alias("tau")), "cutoffs")
    by_block = cutoffs.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int").alias("q")).agg(
        F.collect_list(F.struct("query_id", "tau")).alias("cutoffs")
    )
    none = F.array().cast("array<struct<query_id:bigint,tau:bigint>>")
    told = packed.join(by_block, "q", "left").withColumn("cutoffs", F.coalesce("cutoffs", none))
    resolved = _grid(told, held, query_blocks, row_blocks, ["cutoffs"]).mapInArrow(_phase(k, lists, _resolve), _HITS)
    best = resolved.withColumn("rank", ranked).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(common.read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors)


OP9_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
