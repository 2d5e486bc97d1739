"""Vectors as short codes: product quantisation in whole numbers.

A vector's components, times ``FACTOR`` and rounded down, are cut into ``PARTS`` equal
parts; a part is told by the number of the nearest of its position's ``ENTRIES`` codebook
entries (ties to the lower number). Entries start as the parts of the first vectors by id;
each of ``ROUNDS`` rounds puts the rounded-down mean of an entry's parts in its place.

Nearest entries are found among Walsh-Hadamard coefficients. Parts and entries are padded
with zeros to a power of two ``m`` and transformed, which multiplies squared distances by ``m``
and gathers most of a difference in few coefficients. Squared differences are added up in
sequency order, from the fewest sign changes on; what exceeds the whole distance of one
entry (the best by the first coefficient) can't be nearest and is not carried
on. Nothing is rounded: numbers are 64 bits wide where no sum can pass them, and Python's
own otherwise.

A round reads all vectors in place. A task adds up its parts by entry, and only these sums are
shuffled. The codebooks, ``ENTRIES`` times the length of a vector, pass through the driver.

Defined cases. Vectors that are null or hold a null or non-finite component are dropped. Vectors
shorter than the longest, and lengths that ``PARTS`` doesn't divide, are filled up with
zeros. Fewer than ``ENTRIES`` vectors make as many entries. Null ids come last, and stay null;
of equal ids the smaller vector comes first; repeated rows count each. Null labels are one
label. Errors beyond 64 bits are the greatest 64-bit number. An empty table gives an empty
result. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from authorlink.llm import common

FACTOR, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Pairs of part and entry that are compared at a time.
PAIRS = 1 << 18
_MOST, _SAFE = 2**63 - 1, 2**62


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is there and finite throughout."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & finite)


# --- whole numbers ------------------------------------------------------------


def _floor(x: float, factor: int) -> int:
    # From 2**52 on a double is whole, and its product may be beyond doubles.
    return math.floor(x * factor) if abs(x) < 2.0**52 else int(x) * factor


def whole(values: np.ndarray, offsets: np.ndarray, width: int, factor: int) -> np.ndarray:
    """Rows of ``width`` whole components; as Python's integers if one may not be squared in 64 bits."""
    values = values.astype(np.float64)
    lengths = np.diff(offsets)
    values = values[offsets[0] : offsets[-1]]
    if float(np.abs(values).max(initial=0)) * factor < 2.0**30:
        numbers, out = np.floor(values * factor).astype(np.int64), np.zeros((len(lengths), width), np.int64)
    else:
        numbers, out = np.array([_floor(x, factor) for x in values.tolist()], object), np.zeros((len(lengths), width), object)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(numbers)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = numbers
    return out


def sequency_order(m: int) -> np.ndarray:
    """Which coefficient of the plain transform has 0, 1, 2, … sign changes: the Gray code, its bits reversed."""
    bits = m.bit_length() - 1
    gray = np.arange(m) ^ (np.arange(m) >> 1)
    return sum(((gray >> b) & 1) << (bits - 1 - b) for b in range(bits)) if bits else gray


def transformed(parts: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, zero-padded to a power of two, by sequency."""
    n, d = parts.shape
    m = 1 << max(d - 1, 0).bit_length()
    x = np.zeros((n, m), parts.dtype)
    x[:, :d] = parts
    step = 1
    while step < m:
        pairs = x.reshape(n, m // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, m)
        step *= 2
    return x[:, sequency_order(m)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, of equal ones the first, and the squared distance."""
    most = int(np.abs(parts).max(initial=0)) + int(np.abs(entries).max(initial=0))
    m = 1 << max(parts.shape[1] - 1, 0).bit_length()
    kind = np.int64 if m**3 * most**2 < _SAFE else object
    codes, distances = np.zeros(len(parts), np.int64), np.zeros(len(parts), kind)
    if not len(parts):
        return codes, distances
    e = transformed(entries.astype(kind))
    step = max(1, PAIRS // len(e))
    for at in range(0, len(parts), step):
        x = transformed(parts[at : at + step].astype(kind))
        first = (x[:, None, 0] - e[None, :, 0]) ** 2
        guess = first.argmin(1)
        bound = ((x - e[guess]) ** 2).sum(1)
        row, entry = np.nonzero(first <= bound[:, None])
        total = first[row, entry]
        for k in range(1, m):
            total = total + (x[row, k] - e[entry, k]) ** 2
            left = total <= bound[row]
            if k + 1 < m and not left.all():
                row, entry, total = row[left], entry[left], total[left]
        start = np.flatnonzero(np.diff(row, prepend=-1))
        least = np.minimum.reduceat(total, start)
        hit = np.flatnonzero(total == least[row])
        hit = hit[np.diff(row[hit], prepend=-1) != 0]
        codes[at : at + step], distances[at : at + step] = entry[hit], least // m
    return codes, distances


# --- codebooks ----------------------------------------------------------------


class Codebooks:
    """Entries of every part position, as an array (part, entry, position) of whole numbers."""

    def __init__(self, entries: np.ndarray, width: int, factor: int):
        self.entries, self.width, self.factor = entries, width, factor

    def encoded(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each position: its number, the parts, their codes and squared distances."""
        column = batch.column("embedding")
        rows = whole(column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy(), self.width, self.factor)
        size = self.width // len(self.entries)
        for part, entries in enumerate(self.entries):
            own = rows[:, part * size : (part + 1) * size]
            yield part, own, *nearest(own, entries)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _limbs(value: int) -> list[int]:
    """``value`` in digits of 32 bits, the highest of up to 40 with the sign, so that sums of them stay in 64 bits."""
    out = []
    while not -(2**40) < value < 2**40:
        out.append(value & 0xFFFFFFFF)
        value >>= 32
    return [*out, value]


def _summer(books: Codebooks):
    """Sums of the parts of every entry, in digits; position -1 counts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_parts, n_entries, size = books.entries.shape
        counts, sums = np.zeros((n_parts, n_entries), np.int64), np.zeros((n_parts, n_entries, size), object)
        for batch in batches:
            for part, own, codes, _ in books.encoded(batch):
                counts[part] += np.bincount(codes, minlength=n_entries)
                some = np.zeros((n_entries, size), own.dtype)
                np.add.at(some, codes, own)
                sums[part] += some
        rows = []
        for part, entry in zip(*np.nonzero(counts)):
            rows.append((part, entry, -1, 0, counts[part, entry]))
            for position in range(size):
                digits = _limbs(int(sums[part, entry, position]))
                rows += [(part, entry, position, limb, digit) for limb, digit in enumerate(digits)]
        columns = list(zip(*rows)) or [()] * 5
        names = ["part", "entry", "position", "limb", "digit"]
        kinds = [pa.int32()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def _next(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry that has parts becomes their mean, rounded down."""
    kind = "part int, entry int, position int, limb int, digit long"
    sums = vectors.select("embedding").mapInArrow(_summer(books), kind)
    summed = sums.groupBy("part", "entry", "position", "limb").agg(F.sum("digit").alias("digit")).collect()  # as large as the codebooks
    totals: dict[tuple[int, int, int], int] = {}
    for part, entry, position, limb, digit in summed:
        totals[part, entry, position] = totals.get((part, entry, position), 0) + (digit << (32 * limb))
    entries = books.entries.astype(object)
    for (part, entry, position), total in totals.items():
        if position >= 0:
            entries[part, entry, position] = total // totals[part, entry, -1]
    return Codebooks(_narrow(entries), books.width, books.factor)


def _narrow(entries: np.ndarray) -> np.ndarray:
    small = all(abs(x) < 2**30 for x in entries.ravel().tolist())
    return entries.astype(np.int64) if small else entries.astype(object)


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, factor: int = FACTOR) -> Codebooks | None:
    """Codebooks of the usable vectors ``(vec_id, embedding)``; None if there are none."""
    longest = vectors.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return None
    width = -(-longest // parts) * parts
    start = vectors.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    values = np.array([x for row in start for x in row["embedding"]], np.float64)
    offsets = np.cumsum([0, *(len(row["embedding"]) for row in start)])
    rows = whole(values, offsets, width, factor)
    books = Codebooks(_narrow(rows.reshape(len(start), parts, width // parts).transpose(1, 0, 2)), width, factor)
    for _ in range(rounds):
        books = _next(vectors, books)
    return books


def _coder(books: Codebooks, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, len(books.entries)), np.int64)
            errors = np.zeros(batch.num_rows, object)
            for part, _, of_part, distances in books.encoded(batch):
                codes[:, part] = of_part
                errors += distances
            text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            error = pa.array([min(int(e), _MOST) for e in errors], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(text, pa.string()), error], [*names, "code", "error"])

    return run


def encode(vectors: DataFrame, books: Codebooks, *carried: str) -> DataFrame:
    """``code`` and ``error`` of each vector, after the ``carried`` columns."""
    kept = [vectors.schema[c] for c in carried]
    kind = T.StructType([*kept, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return vectors.select(*carried, "embedding").mapInArrow(_coder(books, list(carried)), kind)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(common.read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    books = codebooks(vectors)
    if books is None:
        vectors = vectors.limit(0)
        books = Codebooks(np.zeros((PARTS, 0, 0), np.int64), 0, FACTOR)
    coded = common.written(encode(vectors, books, "vec_id", "label"), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)")).cast("long")
    of_label = coded.groupBy("label").agg(total.alias("label_error"), F.count(F.lit(1)).alias("n"))
    found = common.looked_up(coded, common.written(of_label, "label-errors"), ["label"], "n")
    return found.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


_NEAREST = """SELECT r, part, min(struct_pack(d := d, e := entry)) AS best FROM (
    SELECT c.r, c.part, b.entry, sum((c.x - b.y) * (c.x - b.y)) AS d FROM cell c JOIN {0} b USING (part, pos) GROUP BY ALL) GROUP BY ALL"""
_MEANS = """SELECT b.part, b.entry, b.pos, coalesce(m.y, b.y) AS y FROM {1} b LEFT JOIN (
    SELECT a.part, a.best.e AS entry, c.pos, CAST(floor(sum(c.x) / count(*)) AS BIGINT) AS y
    FROM {0} a JOIN cell c USING (r, part) GROUP BY ALL) m USING (part, entry, pos)"""
OP12_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cell AS MATERIALIZED (
  SELECT r, (i - 1) // size AS part, (i - 1) % size AS pos, x
  FROM (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept), (SELECT max(len(v)) // 16 AS size FROM kept)),
book_0 AS MATERIALIZED (SELECT part, r - 1 AS entry, pos, x AS y FROM cell WHERE r <= 64),
near_0 AS MATERIALIZED ({_NEAREST.format("book_0")}),
book_1 AS MATERIALIZED ({_MEANS.format("near_0", "book_0")}),
near_1 AS MATERIALIZED ({_NEAREST.format("book_1")}),
book_2 AS MATERIALIZED ({_MEANS.format("near_1", "book_1")}),
near_2 AS MATERIALIZED ({_NEAREST.format("book_2")}),
coded AS (
  SELECT r, string_agg(printf('%02x', CAST(best.e AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near_2 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book_2) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""
