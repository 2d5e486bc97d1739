"""Web archives without repeated payloads: WARC files, and their revisit records.

``write`` makes one record for each capture (a page at a time and address). Only headers are
shuffled, by payload digest: of the captures with equal payloads the one with the smallest page id is the
response, all others become revisit records that name it (``WARC-Refers-To`` and its address and
date) and hold no payload. Every record has fresh headers: an id, date, digest and length of its own.

Payloads stay where they are read. A bitmap of ``BITS`` hashed digests of repeated payloads, of a fixed
size and broadcast, lets the others pass straight to their archive; of those it marks, a task sends each
payload once. (If it marks too much, since there are very many repeated payloads, more of them
move, and the result is the same.)

Archives are gzip files of plain WARC 1.1, written by Spark, as many as there are tasks. ``read`` takes
them back a line at a time, so the size of a file doesn't matter, and cuts records by their
``Content-Length``; a payload may hold anything, also what looks like a record. ``resolved`` joins revisits
with the responses they name. ``deduplicated`` writes archives anew without repeated payloads,
also those with revisits from elsewhere; a revisit whose original is not there stays one, without payload.

Equal payloads are those with the same SHA-1 and length, as in WARC's identical-payload-digest profile.

Defined cases. A null payload is an empty one; payloads of under ``least`` bytes are all responses. Null ids come
after all others, and equal ids in the order of their addresses; of rows that are equal in all of
this, one is the response. Line ends in addresses are percent-encoded. A null address has no
header. An empty table makes archives without records. Extra columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authorlink.llm import common
from authorlink.sources.workspace import Workspace

#: Bits of the bitmap of repeated payloads: 2 MB.
BITS = 1 << 24
#: Bytes of records that a task passes on at a time.
AT_ONCE = 8 << 20

# Of the WARC 1.1 format.
_END = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_KEY = ["digest", "payload_bytes"]


# --- headers -----------------------------------------------------------------


def base32(hexadecimal: Column) -> Column:
    """Base 32 of a SHA-1 in hexadecimal: five digits there are four letters here."""

    def letters(k: Column) -> Column:
        bits = F.conv(F.substring(hexadecimal, k * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*(F.substring(F.lit(_BASE32), F.shiftright(bits, 15 - 5 * i).bitwiseAND(31) + 1, F.lit(1)) for i in range(4)))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), letters), "")


def captures(pages: DataFrame) -> DataFrame:
    """``(page_id, uri, payload, digest, payload_bytes)`` of pages ``(page_id, url, html)``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    address = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), address.alias("uri"), payload.alias("payload"))
    return rows.withColumns({"digest": base32(F.sha1("payload")), "payload_bytes": F.octet_length("payload").cast("long")})


def _urn(hexadecimal: Column) -> Column:
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(hexadecimal, a, n) for a, n in cuts)), F.lit(">"))


def _original_id() -> Column:
    """The id of the response that others refer to; there is one for each payload."""
    return _urn(F.md5(F.concat_ws(":", *_KEY)))


def _fresh_id() -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))


def _record(kind: str, record_id: Column, date: str, http: bool, payload: Column, *more: tuple[str, Column]) -> Column:
    """The text of a record but for its end; headers without a value are left out."""
    size = F.coalesce(F.col("payload_bytes").cast("string"), F.lit("0"))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), size, F.lit(_END * 2))
    head = head if http else F.lit("")
    length = (F.octet_length(head) + F.octet_length(payload)).cast("string")
    named = [
        ("WARC-Type", F.lit(kind)),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.col("uri")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("X-Page-ID", F.col("page_id").cast("string")),
        *more,
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", length),
    ]
    lines = F.concat_ws(_END, F.lit("WARC/1.1"), *(F.concat(F.lit(f"{name}: "), value) for name, value in named))
    # The bytes of a payload need not be text; the cast takes them as they are.
    return F.concat(lines, F.lit(_END * 2), head, payload.cast("string")).alias("value")


# --- writing -----------------------------------------------------------------


def _first() -> Column:
    return F.struct(F.col("page_id").isNull().alias("a"), "page_id", F.col("uri").isNull().alias("b"), "uri")


def _repeated(headers: DataFrame, least: int) -> DataFrame:
    """``(digest, payload_bytes, n, page_id, uri)`` of each payload that several captures have, and the first of these."""
    summed = headers.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.min(_first()).alias("first"), F.max("held").alias("held"))
    wanted = summed.where((F.col("n") > 1) & (F.col("payload_bytes") >= least) & F.col("held"))
    return wanted.select(*_KEY, "n", F.col("first.page_id").alias("page_id"), F.col("first.uri").alias("uri"))


def _marked(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Add ``marked``: may the payload be a repeated one (it is not if this is false)."""
    bit = F.pmod(F.xxhash64(*_KEY), F.lit(BITS)) + 1
    bits = repeated.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("position"))
    maps = bits.groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bitmap"))  # at most BITS / 32768 rows of 4 KB
    position = F.bitmap_bit_position(bit)
    byte = F.substring("bitmap", (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (position % 8).cast("int")) == 1
    found = rows.join(F.broadcast(maps), F.bitmap_bucket_number(bit) == F.col("bucket"), "left")
    return found.select(*rows.columns, F.coalesce(is_set, F.lit(False)).alias("marked"))


def _revisits(headers: DataFrame, repeated: DataFrame, total: int) -> DataFrame:
    """``(page_id, uri, digest, payload_bytes, first_id, first_uri)`` of all captures of repeated payloads but the first."""
    twins = headers.groupBy("page_id", "uri", *_KEY).agg(F.count(F.lit(1)).alias("copies"))
    twins = common.written(twins.join(repeated.select(*_KEY), _KEY, "left_semi"), "repeated-captures")
    named = repeated.withColumnsRenamed({"page_id": "first_id", "uri": "first_uri"})
    told = common.looked_up(twins, named, _KEY, "n", total, "inner")
    is_first = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("uri").eqNullSafe(F.col("first_uri"))
    left = F.col("copies") - is_first.cast("int")
    each = told.where(left > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
    return each.select("page_id", "uri", *_KEY, "first_id", "first_uri")


def write_captures(rows: DataFrame, folder: str, least: int = 0, date: str | None = None) -> None:
    """Write captures as archives; those without ``payload`` (null) have the digest and length of one that has, or of none."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    headers = common.written(rows.select("page_id", "uri", *_KEY, F.col("payload").isNotNull().alias("held")), "capture-headers")
    repeated = common.written(_repeated(headers, least), "repeated-payloads")
    with_payload = rows.where("payload IS NOT NULL")
    payload = F.col("payload")
    if repeated.limit(1).count() == 0:
        records = with_payload.select(_record("response", _fresh_id(), date, True, payload))
    else:
        told = _marked(with_payload, repeated)
        records = told.where("NOT marked").select(_record("response", _fresh_id(), date, True, payload))
        moved = told.where("marked").select(*_KEY, "payload", "page_id", "uri")
        is_repeated = repeated.select(*_KEY, F.col("page_id").alias("first_id"), F.col("uri").alias("first_uri"))
        # Payloads are combined in every task before they move; those marked in error are few.
        payloads = moved.groupBy(*_KEY).agg(F.min("payload").alias("payload"), F.count(F.lit(1)).alias("_n"), F.min(_first()).alias("first"))
        originals = payloads.join(is_repeated, _KEY).select(*_KEY, "payload", F.col("first_id").alias("page_id"), F.col("first_uri").alias("uri"))
        records = records.unionByName(originals.select(_record("response", _original_id(), date, True, payload)))
        others = moved.join(is_repeated, _KEY, "left_anti")
        records = records.unionByName(others.select(_record("response", _fresh_id(), date, True, payload)))
        referring = [
            ("WARC-Profile", F.lit(_PROFILE)),
            ("WARC-Refers-To", _original_id()),
            ("WARC-Refers-To-Target-URI", F.col("first_uri")),
            ("WARC-Refers-To-Date", F.lit(date)),
        ]
        revisits = _revisits(headers, repeated, headers.count())
        records = records.unionByName(revisits.select(_record("revisit", _fresh_id(), date, True, F.lit(b""), *referring)))
    dangling = headers.where("NOT held").join(repeated.select(*_KEY), _KEY, "left_anti")
    records = records.unionByName(dangling.select(_record("revisit", _fresh_id(), date, True, F.lit(b""), ("WARC-Profile", F.lit(_PROFILE)))))
    writer = records.write.option("lineSep", _END * 2).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.text(folder)


def write(pages: DataFrame, folder: str, least: int = 0, date: str | None = None) -> None:
    """Write pages ``(page_id, url, html)`` as archives under a new ``folder``, repeated payloads once."""
    write_captures(captures(pages), folder, least, date)


# --- reading -----------------------------------------------------------------

# Headers that are read, and the columns they fill.
_HEADERS = {
    b"warc-type": "record_type",
    b"warc-record-id": "record_id",
    b"warc-date": "date",
    b"warc-target-uri": "uri",
    b"warc-payload-digest": "digest",
    b"x-page-id": "page_id",
    b"warc-refers-to": "refers_to",
    b"warc-refers-to-target-uri": "refers_to_uri",
    b"warc-refers-to-date": "refers_to_date",
}
_TEXTS = [c for c in _HEADERS.values() if c != "page_id"]
_READ = ", ".join([*(f"{c} string" for c in _TEXTS), "page_id long", "payload_bytes long", "payload binary"])


class _Record:
    """One record of an archive, as its lines come in."""

    def __init__(self):
        self.columns: dict[str, str] = {}
        self.need, self.got = -1, 0
        self.length, self.http = 0, False
        self.block: list[bytes] = []

    def header(self, line: bytes) -> None:
        name, _, value = line.partition(b":")
        name, value = name.strip().lower(), value.strip()
        if name in _HEADERS:
            self.columns[_HEADERS[name]] = value.decode("utf-8", "replace")
        elif name == b"content-length":
            self.length = int(value)
        elif name == b"content-type":
            self.http = value.startswith(b"application/http")

    def row(self, payloads: bool) -> dict:
        block = (b"\n".join(self.block) + b"\n")[: self.need]
        if self.http:
            head, _, block = block.partition(b"\r\n\r\n")
        row = dict(self.columns)
        row["digest"] = row["digest"].removeprefix("sha1:") if "digest" in row else None
        row["page_id"] = int(row["page_id"]) if "page_id" in row else None
        if row.get("record_type") != "revisit":
            # What is there counts, not what a header says of it.
            row["digest"] = base64.b32encode(hashlib.sha1(block).digest()).decode()
            row["payload_bytes"], row["payload"] = len(block), block if payloads else None
        return row


def _parser(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, record, rows, held = None, None, [], 0
        for batch in batches:
            for of_file, line in zip(batch.column("file").to_pylist(), batch.column("line").to_pylist()):
                if of_file != file:
                    file, record = of_file, None
                if record is None:
                    if line.startswith(b"WARC/1."):
                        record = _Record()
                    continue
                if record.need < 0:
                    if line.strip():
                        record.header(line)
                        continue
                    record.need = record.length
                else:
                    record.block.append(line)
                    record.got += len(line) + 1
                if record.got >= record.need:
                    rows.append(record.row(payloads))
                    held += record.need if payloads else 0
                    record = None
                    if held >= AT_ONCE or len(rows) >= 5000:
                        yield table(rows)
                        rows, held = [], 0
        yield table(rows)

    def table(rows: list[dict]) -> pa.RecordBatch:
        kinds = {**{c: pa.string() for c in _TEXTS}, "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in kinds.items()], list(kinds))

    return run


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under ``folder``: their headers, and the payloads of those that are not revisits."""
    lines = spark.read.option("lineSep", "\n").text(folder)
    lines = lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))
    return lines.mapInArrow(_parser(payloads), _READ)


def resolved(records: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of records; revisits joined to their responses."""
    headers = common.written(records.drop("payload"), "read-headers")
    revisits = headers.where("record_type = 'revisit'")
    times = revisits.where("refers_to IS NOT NULL").groupBy("refers_to").agg(F.count(F.lit(1)).alias("n"))
    responses = headers.where("record_type = 'response'")
    named = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("first_id"), F.col("payload_bytes").alias("first_bytes"))
    originals = common.written(named.join(times, "refers_to"), "originals")
    told = common.looked_up(revisits, originals, ["refers_to"], "n")
    columns = ["page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type"]
    of_revisits = told.withColumn("payload_bytes", F.col("first_bytes")).select(*columns, F.col("first_id").alias("refers_to"))
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(of_revisits)


def deduplicated(spark: SparkSession, source: str, folder: str, least: int = 0, date: str | None = None) -> None:
    """Write the archives under ``source`` anew under ``folder``, every payload once.

    A revisit takes part by its digest and the length of the response it refers to.
    """
    records = read(spark, source)
    of_revisits = resolved(records).where("record_type = 'revisit'").groupBy(F.col("payload_digest").alias("digest"))
    lengths = common.written(of_revisits.agg(F.max("payload_bytes").alias("_bytes"), F.count(F.lit(1)).alias("n")), "revisit-lengths")
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes")
    revisits = common.looked_up(revisits, lengths, ["digest"], "n").withColumn("payload_bytes", F.coalesce("_bytes", F.lit(-1)))
    columns = ["page_id", "uri", "payload", *_KEY]
    rows = records.where("record_type = 'response'").select(*columns).unionByName(revisits.select(*columns))
    write_captures(rows, folder, least, date)


def op13_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{Workspace(spark).path}/archives"
    write(common.read(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return resolved(read(spark, folder, payloads=False))


OP13_SQL = r"""
WITH payload AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
hashed AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM payload),
letters AS (SELECT *, list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)),
    lambda a, b: a || b) AS payload_digest FROM hashed),
numbered AS (SELECT *, row_number() OVER (PARTITION BY payload_digest, payload_bytes ORDER BY page_id) AS n,
    min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM letters)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN n > 1 THEN first END AS refers_to FROM numbered
"""
