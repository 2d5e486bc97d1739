"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

Built from SQL functions alone. A text is cut into paragraphs (at line ends and
after sentence marks, and at the latest after ``LONGEST`` characters), and each
distinct paragraph becomes a 64-bit digest. A sketch has three tables of cells; a
digest goes to one cell of each. A cell keeps the number of its digests, their XOR
and the XOR of their hashes. Subtracting the sketches of two versions cell by cell
cancels what they share. Peeling then takes out, round by round, the digests that
are alone in a cell (count one, hash fits), until every cell is empty: what was
taken out are the paragraphs that differ.

The fingerprint is the sketch with ``3 * BASE`` cells. If the difference of two of
them doesn't peel, a larger sketch is tried: digests are dealt by some of their bits
to as many blocks as there are digests for ``PER_BLOCK`` in each, and every block has
a sketch with ``3 * WIDE`` cells; a block that fails is tried again with four times
the cells, placed by other bits. A block that fails then too (digests that share all
their cells) is compared digest by digest.

Likeness is the share of common paragraphs among all: ``(n - d) / (n + d)``, where
``n`` digests are in the two sketches together and ``d`` were recovered.

Documents meet the next ones in order of id without a global window: bounds from
the ids' quantiles deal them to buckets, one shuffle sorts each bucket, and the
first document of every bucket also goes to the end of the bucket before. Sketches
are made within the row.

Defined cases. A null text is empty; an empty text has no paragraphs, and two of
them have likeness 1. Null ids come first in order; repeated ids are ordered by
text, repeated rows stand beside each other. A single document is its own next
one. An empty table gives an empty result. Very long texts have as many paragraphs
as they need. Extra columns are not carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from authorlink.llm import common

LONGEST = 80
PARAGRAPH = rf"[^.!?\n]{{1,{LONGEST}}}[.!?\n]*|[.!?\n]+"
#: Cells of a table in the fingerprint, in a block's sketch and in its repetition; digests in a block.
BASE, WIDE, WIDER, PER_BLOCK = 4, 4, 16, 4
#: Rounds of peeling: as many as there can be recovered digests in a row.
ROUNDS = 8
#: First bits of a digest that choose its cells (three times) and its block (twice), apart from each other.
_BASE_BITS, _WIDE_BITS, _WIDER_BITS, _BLOCK_BITS = (0, 2, 4), (6, 8, 10), (12, 16, 20), (32, 44)
#: Documents in a bucket, unless there would be over MOST_BUCKETS: their bounds are held by the driver and the plan.
BUCKET, MOST_BUCKETS = 400, 65_536

_CELL = "struct<n:int,key:bigint,hash:bigint>"


def digests(text: Column) -> Column:
    """Distinct digests of a text's paragraphs, sorted."""
    found = F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda p: F.xxhash64(p))))


def _hash(key: Column) -> Column:
    return F.xxhash64(key, F.lit(1))


def _cell(n: Column, key: Column, hash_: Column) -> Column:
    return F.struct(n.alias("n"), key.alias("key"), hash_.alias("hash"))


def _nothing() -> Column:
    return F.lit(0).cast("int"), F.lit(0).cast("bigint"), F.lit(0).cast("bigint")


def _place(key: Column, first_bit: int, size: int) -> Column:
    return F.shiftrightunsigned(key, first_bit).bitwiseAND(F.lit(size - 1).cast("bigint"))


def _with(sign: int):
    def put(cell: Column, key: Column) -> Column:
        return _cell(cell["n"] + sign, cell["key"].bitwiseXOR(key), cell["hash"].bitwiseXOR(_hash(key)))

    return put


def difference(own: Column, other: Column | None, bits: tuple[int, int, int], size: int) -> Column:
    """Cells of the digests ``own`` less those of ``other``, table by table."""

    def table(bit: int) -> Column:
        def cell(j: Column) -> Column:
            got = F.aggregate(F.filter(own, lambda d: _place(d, bit, size) == j), _cell(*_nothing()), _with(1))
            if other is not None:
                got = F.aggregate(F.filter(other, lambda d: _place(d, bit, size) == j), got, _with(-1))
            return got

        return F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(size - 1).cast("bigint")), cell)

    return F.concat(*(table(bit) for bit in bits))


def subtracted(own: Column, other: Column) -> Column:
    return F.zip_with(
        own,
        other,
        lambda a, b: _cell(a["n"] - b["n"], a["key"].bitwiseXOR(b["key"]), a["hash"].bitwiseXOR(b["hash"])),
    )


def peeled(cells: Column, bits: tuple[int, int, int], size: int) -> Column:
    """The digests that differ; null if some cells don't empty."""
    def empty(cell: Column) -> Column:
        return (cell["n"] == 0) & (cell["key"] == 0) & (cell["hash"] == 0)

    def alone(state: Column) -> Column:
        return F.array_distinct(F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["hash"] == _hash(c["key"]))))

    def take(cell: Column, t: Column) -> Column:
        return _cell(cell["n"] - t["n"], cell["key"].bitwiseXOR(t["key"]), cell["hash"].bitwiseXOR(t["hash"]))

    def without(cells: Column, taken: Column) -> Column:
        def table(first: int, bit: int) -> Column:
            return F.transform(
                F.slice(cells, first + 1, size),
                lambda cell, i: F.aggregate(F.filter(taken, lambda t: _place(t["key"], bit, size) == i), cell, take),
            )

        return F.concat(*(table(k * size, bit) for k, bit in enumerate(bits)))

    def next_(state: Column, taken: Column) -> Column:
        after = F.struct(
            without(state["cells"], taken).alias("cells"),
            F.concat(state["found"], F.transform(taken, lambda t: t["key"])).alias("found"),
            F.lit(True).alias("open"),
        )
        stuck = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("open"))
        return F.when(F.size(taken) > 0, after).otherwise(stuck)

    def round_(state: Column, _: Column) -> Column:
        # An array of one binds what is alone, so that it is looked for once a round.
        bound = F.transform(F.array(alone(state)), lambda taken: next_(state, taken))
        return F.when(state["open"], F.get(bound, F.lit(0))).otherwise(state)

    first = F.struct(cells.alias("cells"), F.array().cast("array<bigint>").alias("found"), F.lit(True).alias("open"))
    last = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, round_)
    ended = F.transform(F.array(last), lambda s: F.when(F.forall(s["cells"], empty), s["found"]))
    return F.get(ended, F.lit(0))


def _blocks(own: Column, other: Column) -> Column:
    """Both versions' digests, dealt to blocks: ``array<struct<a, b>>``."""
    n = F.greatest(F.size(own) + F.size(other), F.lit(1))
    bits = F.greatest(F.ceil(F.log2(n / F.lit(float(PER_BLOCK)))), F.lit(0)).cast("int")
    low = F.least(F.floor(bits / 2).cast("int"), F.lit(12))
    high = F.least(bits - low, F.lit(12))

    def mask(bits: Column) -> Column:
        return (F.pow(F.lit(2.0), bits) - 1).cast("bigint")

    def deal(pair: Column, first_bit: int, mask: Column) -> Column:
        def block(side: str, i: Column) -> Column:
            return F.filter(pair[side], lambda d: F.shiftrightunsigned(d, first_bit).bitwiseAND(mask) == i).alias(side)

        return F.transform(F.sequence(F.lit(0).cast("bigint"), mask), lambda i: F.struct(block("a", i), block("b", i)))

    def dealt(whole: Column) -> Column:
        return F.flatten(
            F.transform(deal(whole, _BLOCK_BITS[0], whole["low"]), lambda pair: deal(pair, _BLOCK_BITS[1], whole["high"]))
        )

    # An array of one binds the masks, which are else worked out again for each digest.
    whole = F.struct(own.alias("a"), other.alias("b"), mask(low).alias("low"), mask(high).alias("high"))
    return F.get(F.transform(F.array(whole), dealt), F.lit(0))


def differing(own: Column, other: Column, own_cells: Column, other_cells: Column) -> Column:
    """Digests in one version only, by peeling the fingerprints' difference or, where that fails, larger sketches."""

    def of_block(pair: Column) -> Column:
        return F.coalesce(
            peeled(difference(pair["a"], pair["b"], _WIDE_BITS, WIDE), _WIDE_BITS, WIDE),
            peeled(difference(pair["a"], pair["b"], _WIDER_BITS, WIDER), _WIDER_BITS, WIDER),
            F.concat(F.array_except(pair["a"], pair["b"]), F.array_except(pair["b"], pair["a"])),
        )

    return F.coalesce(
        peeled(subtracted(own_cells, other_cells), _BASE_BITS, BASE),
        F.flatten(F.transform(_blocks(own, other), of_block)),
    )


def _as_text(n: Column, cells: Column) -> Column:
    """A fingerprint as text: the number of digests, then its cells."""
    shown = F.transform(
        cells, lambda c: F.concat_ws("-", c["n"].cast("string"), F.lower(F.hex(c["key"])), F.lower(F.hex(c["hash"])))
    )
    return F.concat_ws(".", n.cast("string"), shown)


def _likeness(n: Column, d: Column) -> Column:
    return F.when(n > 0, (n - d) / (n + d)).otherwise(F.lit(1.0))


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """The number of bounds up to the id, less one; found among about twice the root of their number."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*(F.lit(g[0]).cast("long") for g in groups))
    group = F.size(F.filter(heads, lambda b: b <= doc_id)) - 1
    inner = F.get(F.array(*(F.lit(g).cast("array<bigint>") for g in groups)), group)
    return F.coalesce(group * step + F.size(F.filter(inner, lambda b: b <= doc_id)) - 1, F.lit(0))


def with_next(docs: DataFrame, per_bucket: int = BUCKET) -> tuple[DataFrame, Window]:
    """``(bucket, guest, doc_id, text)`` and the window in which the next row is the next document; guests are no rows of their own."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    n = docs.count()
    buckets = max(1, min(common.tasks_for(n, per_bucket), MOST_BUCKETS))
    shares = [i / buckets for i in range(buckets)]
    found = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * buckets)), F.min("doc_id")).first()
    bounds = sorted({*(found[0] or []), found[1]} - {None})
    dealt = docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), 0).otherwise(_bucket(F.col("doc_id"), bounds)))
    n_buckets = max(1, len(bounds))
    bound = docs.sparkSession.range(1).select(F.explode(F.lit(bounds).cast("array<bigint>")).alias("bound"))
    # At most MOST_BUCKETS bounds.
    starting = dealt.join(F.broadcast(bound), F.col("doc_id") == F.col("bound"), "left_semi").unionByName(dealt.where("doc_id IS NULL"))
    first = starting.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "text")).alias("first"))
    guests = first.select(
        F.col("first.doc_id").alias("doc_id"),
        F.col("first.text").alias("text"),
        F.pmod(F.col("bucket") - 1, F.lit(n_buckets)).cast("int").alias("bucket"),
        F.lit(True).alias("guest"),
    )
    rows = dealt.withColumn("bucket", F.col("bucket").cast("int")).withColumn("guest", F.lit(False)).unionByName(guests)
    return rows, Window.partitionBy("bucket").orderBy("guest", "doc_id", "text")


def compared(docs: DataFrame, per_bucket: int = BUCKET) -> DataFrame:
    """Fingerprints of each document and its edited text, and the digests in which it differs from that and from the next."""
    rows, window = with_next(docs, per_bucket)
    text, share = F.col("text"), F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn("n_chars", F.length("text")).withColumn("_next", F.lead("text").over(window))
    kept = F.substring(text, F.lit(1), F.col("n_chars") - share)
    rows = rows.withColumn("_edited", F.concat(kept, F.substring("_next", F.lit(1), share))).drop("_next")
    rows = rows.withColumn("_own", digests(text))
    rows = rows.withColumn("_own_cells", difference(F.col("_own"), None, _BASE_BITS, BASE))
    rows = rows.withColumn("_beside", F.lead(F.struct("_own", "_own_cells")).over(window)).where("NOT guest")
    rows = rows.select("doc_id", "n_chars", "_own", "_own_cells", "_beside", F.sha2("_edited", 256).alias("edited_sha256"), digests(F.col("_edited")).alias("_new"))
    rows = rows.withColumn("_new_cells", difference(F.col("_new"), None, _BASE_BITS, BASE))
    own, cells = F.col("_own"), F.col("_own_cells")
    return rows.select(
        "*",
        differing(own, F.col("_new"), cells, F.col("_new_cells")).alias("differs_edited"),
        differing(own, F.col("_beside._own"), cells, F.col("_beside._own_cells")).alias("differs_next"),
    )


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = compared(common.read(spark, sf_dir, "documents"))
    n_own = F.size("_own")
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        _as_text(n_own, F.col("_own_cells")).alias("fingerprint"),
        _as_text(F.size("_new"), F.col("_new_cells")).alias("edited_fingerprint"),
        _likeness(n_own + F.size("_new"), F.size("differs_edited")).alias("near_edited"),
        _likeness(n_own + F.size("_beside._own"), F.size("differs_next")).alias("near_next"),
    )
