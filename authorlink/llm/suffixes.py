"""Removal of long strings that an earlier document holds, by sorting suffixes.

A string of ``span`` bytes that starts in a document with a smaller id is removed
wherever it occurs. Sorting all suffixes would move ``span`` bytes for every byte of
text, more than fifty times the input. Here only suffixes that can matter are sorted:

1. Texts fall into runs of strings with the same anchor (``anchors``), about one run
   for 16 bytes. Runs with equal bytes are equal strings throughout. For each run a
   hash of its anchor and a hash of its bytes, ten bytes together, go to the bucket of
   the anchor; runs that are equal within a task meet there first, and only the one
   with the smallest id is sent.
2. In a bucket, a run whose bytes an earlier document has is settled: all its strings
   go. Other runs whose anchor occurs with other bytes around it are open: part of
   their strings may stand elsewhere. They are a few percent, near the ends of
   repeated passages. All others are unique.
3. Open runs fetch their bytes. Their suffixes are range-partitioned by their leading
   bytes with sampled splitters, so that equal ones never stand on two sides of a
   boundary; each part sorts its strings word by word, the first eight bytes first,
   and compares neighbours: within equal strings all but those of the smallest id go.
   An anchor with over ``HOT`` open runs is not left to one task: its strings are
   rows, whose smallest ids Spark sums up in every task before the shuffle.
4. The runs of strings to be removed join their document, are merged and cut out.

Hashes of 40 bits only choose what is compared: the bucket and, among the runs of one
anchor, the equal ones (a false match there needs two runs of the same anchor to agree
in 40 bits). Open runs are compared byte by byte.

Defined cases. A null text is empty; texts shorter than ``span`` bytes lose nothing.
Equal ids are not smaller than each other. A null id counts as the greatest.
Repeated rows (same id and text) get the same result. An empty table gives an empty
result. Very long texts are read in parts that overlap. Extra columns are not carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authorlink.llm import common
from authorlink.llm.anchors import GRAM, SPAN, runs

#: Runs that a task gathers before it sends them, runs in a bucket, documents whose answers are put together in a task.
AT_ONCE, IN_BUCKET, AT_HOME = 500_000, 800_000, 10_000
#: Open runs of one anchor that a task still sorts, and open runs sorted together.
HOT, SORTED = 200_000, 40_000
_LAST = 2**63 - 1

_SENT = "bucket int, home int, docs binary, start binary, count binary, offset binary, gram binary, whole binary"
_TOLD = "home int, open boolean, docs binary, start binary, count binary, offset binary"
_OF_DOC = "id long, crc long, settled binary, open binary"
_CONTEXT = "lead binary, id long, crc long, start int, count int, bytes binary"
_REMOVED = "id long, crc long, start int, count int"
_DOC = np.dtype([("id", "<i8"), ("crc", "<u4"), ("n", "<u4")])


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))


def _keyed(docs: DataFrame) -> DataFrame:
    text = common.text_or_empty().cast("binary")
    return docs.select("doc_id", _id().alias("id"), F.crc32(text).alias("crc"), text.alias("bytes"))


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each number, byte by byte, which packs well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view("<u8")[:, 0]


#: Bytes of each column of a run on its way.
_WIDTHS = {"start": 4, "count": 1, "offset": 1, "gram": 5, "whole": 5}


def _pack(run: dict[str, np.ndarray], names: tuple[str, ...]) -> dict[str, bytes]:
    order = np.lexsort((run["start"], run["crc"], run["id"]))
    run = {k: v[order] for k, v in run.items()}
    new = np.ones(len(order), bool)
    new[1:] = (run["id"][1:] != run["id"][:-1]) | (run["crc"][1:] != run["crc"][:-1])
    first = np.flatnonzero(new)
    docs = np.zeros(len(first), _DOC)
    docs["id"], docs["crc"], docs["n"] = run["id"][first], run["crc"][first], np.diff(first, append=len(order))
    start = run["start"].copy()
    start[1:] -= np.where(new[1:], 0, run["start"][:-1])
    out = {"docs": docs.tobytes(), "start": _planes(start, 4)}
    return out | {name: _planes(run[name], _WIDTHS[name]) for name in names if name != "start"}


def _unpack(row: dict[str, bytes], names: tuple[str, ...]) -> dict[str, np.ndarray]:
    docs = np.frombuffer(row["docs"], _DOC)
    n = docs["n"].astype(np.int64)
    start = _unplanes(row["start"], 4).astype(np.int64)
    sums = np.cumsum(start)
    first = np.cumsum(n) - n
    before = np.where(first > 0, sums[first - 1], 0) if len(first) else first
    run = {"id": np.repeat(docs["id"], n), "crc": np.repeat(docs["crc"].astype(np.int64), n), "start": sums - np.repeat(before, n)}
    return run | {name: _unplanes(row[name], _WIDTHS[name]) for name in names if name != "start"}


def _together(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _of(run: dict[str, np.ndarray], which: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[which] for k, v in run.items()}


def _first_of(run: dict[str, np.ndarray], *names: str) -> np.ndarray:
    """Where the first of each combination of values stands, in runs sorted by them."""
    new = np.zeros(len(run["id"]), bool)
    new[:1] = True
    for name in names:
        new[1:] |= run[name][1:] != run[name][:-1]
    return new


def _sorted(run: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """By anchor, bytes, document and place, each once."""
    run = _of(run, np.lexsort((run["start"], run["crc"], run["id"], run["whole"], run["gram"])))
    return _of(run, _first_of(run, "gram", "whole", "id", "crc", "start"))


def _home(run: dict[str, np.ndarray], homes: int) -> np.ndarray:
    x = run["id"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(33)) % np.uint64(homes)).astype(np.int64)


_ALL = ("start", "count", "offset", "gram", "whole")
_TELL = ("start", "count", "offset")


def _sender(buckets: int, homes: int, span: int, gram: int):
    def flush(held: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        run = _sorted(_together(held))
        same = _first_of(run, "gram", "whole")
        later = run["id"] > run["id"][np.flatnonzero(same)[np.cumsum(same) - 1]]
        rows = []
        sent = _of(run, ~later)
        bucket = (sent["gram"] % np.uint64(buckets)).astype(np.int64)
        for b in np.unique(bucket).tolist():
            rows.append({"bucket": b, "home": -1} | _pack(_of(sent, bucket == b), _ALL))
        settled = _of(run, later)
        home = _home(settled, homes)
        for h in np.unique(home).tolist():
            rows.append({"bucket": h % buckets, "home": h, "gram": None, "whole": None} | _pack(_of(settled, home == h), _TELL))
        yield _batch(rows, _SENT)

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids = np.array(batch.column("id").to_pylist(), np.int64)
            crcs = np.array(batch.column("crc").to_pylist(), np.int64)
            for r in runs(batch.column("bytes").to_pylist(), span, gram):
                held.append(
                    {
                        "id": ids[r.text],
                        "crc": crcs[r.text],
                        "start": r.start,
                        "count": r.count,
                        "offset": r.offset,
                        "gram": r.gram >> np.uint64(24),
                        "whole": r.whole >> np.uint64(24),
                    }
                )
                n += len(r.start)
                if n >= AT_ONCE:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)

    return run_


def _batch(rows: list[dict], layout: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in layout.split(", "))])
    return pa.RecordBatch.from_pylist(rows, schema)


def _answer(homes: int):
    def answer(table: pa.Table) -> pa.Table:
        rows, asked = [], []
        for row in table.to_pylist():
            if row["home"] >= 0:
                rows.append({"home": row["home"], "open": False} | {k: row[k] for k in ("docs", *_TELL)})
            else:
                asked.append(_unpack(row, _ALL))
        if asked:
            run = _sorted(_together(asked))
            anchor, same = _first_of(run, "gram"), _first_of(run, "gram", "whole")
            of_anchor, of_same = np.cumsum(anchor) - 1, np.cumsum(same) - 1
            settled = run["id"] > run["id"][np.flatnonzero(same)[of_same]]
            starts = np.flatnonzero(anchor)
            several = np.add.reduceat(same.astype(np.int64), starts) > 1
            several &= np.minimum.reduceat(run["id"], starts) != np.maximum.reduceat(run["id"], starts)
            for open_, which in ((False, settled), (True, ~settled & several[of_anchor])):
                found = _of(run, which)
                home = _home(found, homes)
                for h in np.unique(home).tolist():
                    rows.append({"home": h, "open": open_} | _pack(_of(found, home == h), _TELL))
        return pa.Table.from_batches([_batch(rows, _TOLD)])

    return answer


def _gather(table: pa.Table) -> pa.Table:
    """One row for each document: its settled and its open runs as ``(start, count, offset)``."""
    parts: dict[bool, list] = {False: [], True: []}
    for row in table.to_pylist():
        parts[row["open"]].append(_unpack(row, _TELL))
    of_doc: dict[tuple[int, int], dict] = {}
    for open_, name in ((False, "settled"), (True, "open")):
        if not parts[open_]:
            continue
        run = _together(parts[open_])
        run = _of(run, np.lexsort((run["start"], run["crc"], run["id"])))
        first = np.flatnonzero(_first_of(run, "id", "crc"))
        for a, b in zip(first, np.append(first[1:], len(run["id"]))):
            key = (int(run["id"][a]), int(run["crc"][a]))
            places = np.stack([run[k][a:b].astype(np.int32) for k in _TELL], axis=1)
            of_doc.setdefault(key, {"id": key[0], "crc": key[1], "settled": None, "open": None})[name] = places.tobytes()
    return pa.Table.from_batches([_batch(list(of_doc.values()), _OF_DOC)])


def _places(data: bytes | None) -> np.ndarray:
    return np.frombuffer(data or b"", np.int32).reshape(-1, 3).astype(np.int64)


def _contexts(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                data = row["bytes"]
                for start, count, offset in _places(row["open"]).tolist():
                    rows.append(
                        {
                            "lead": data[start + offset : start + offset + gram],
                            "id": row["id"],
                            "crc": row["crc"],
                            "start": start,
                            "count": count,
                            "bytes": data[start : start + count - 1 + span],
                        }
                    )
            yield _batch(rows, _CONTEXT)

    return run


def _repeated(table: pa.Table, span: int) -> pa.RecordBatch:
    """Strings of open runs that an earlier document has: all strings sorted word by word, neighbours compared."""
    count = table["count"].to_numpy().astype(np.int64)
    data = np.frombuffer(b"".join(table["bytes"].to_pylist()) + b"\0" * 8, np.uint8)
    length = count - 1 + span
    first = np.cumsum(length) - length
    of_run = np.repeat(np.arange(len(count)), count)
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = first[of_run] + inner
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    ends = [*range(0, span - 8, 8), span - 8]
    key = [np.ascontiguousarray(words[at + e]).view(">u8")[:, 0] for e in ends]
    id_ = table["id"].to_numpy()[of_run]
    order = np.lexsort((id_, *reversed(key)))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in key])
    least = id_[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
    gone = np.sort(order[id_[order] > least])
    # Strings in a row of the same run go as one.
    begins = np.ones(len(gone), bool)
    begins[1:] = (gone[1:] != gone[:-1] + 1) | (of_run[gone[1:]] != of_run[gone[:-1]])
    head = np.flatnonzero(begins)
    run = of_run[gone[head]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(table["id"].to_numpy()[run]),
            pa.array(table["crc"].to_numpy()[run]),
            pa.array((table["start"].to_numpy()[run] + inner[gone[head]]).astype(np.int32)),
            pa.array(np.diff(head, append=len(gone)).astype(np.int32)),
        ],
        ["id", "crc", "start", "count"],
    )


def _sorter(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []
        for batch in batches:
            kept.append(pa.Table.from_batches([batch]))
            if sum(map(len, kept)) >= SORTED:
                table = pa.concat_tables(kept)
                lead = table["lead"].to_pylist()
                cut = len(lead) - 1
                while cut and lead[cut] == lead[cut - 1]:
                    cut -= 1
                if cut:
                    yield _repeated(table.slice(0, cut), span)
                kept = [table.slice(cut)]
        if kept and len(table := pa.concat_tables(kept)):
            yield _repeated(table, span)

    return run


def _hot_strings(contexts: DataFrame, span: int) -> DataFrame:
    """The same for anchors with too many open runs for a task: a row for each string."""
    strings = contexts.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("count") - 1))).select(
        "id", "crc", (F.col("start") + F.col("_i")).alias("start"), F.expr(f"substring(bytes, _i + 1, {span})").alias("string")
    )
    least = strings.groupBy("string").agg(F.min("id").alias("least"))
    gone = strings.join(least, "string").where("id > least")
    return gone.select("id", "crc", "start", F.lit(1).alias("count"))


def repeated(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``(id, crc, settled, found)``: places of strings to remove, of the documents that have some."""
    keyed = _keyed(docs)
    n_docs, n_bytes = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    buckets = common.tasks_for((n_bytes or 0) // 16, IN_BUCKET)
    homes = common.tasks_for(n_docs, AT_HOME)
    sent = keyed.select("id", "crc", "bytes").mapInArrow(_sender(buckets, homes, span, gram), _SENT)
    told = sent.groupBy("bucket").applyInArrow(_answer(homes), _TOLD)
    of_doc = common.written(told.groupBy("home").applyInArrow(_gather, _OF_DOC), "runs")
    fetched = keyed.join(of_doc.where("open IS NOT NULL").select("id", "crc", "open"), ["id", "crc"])
    contexts = fetched.select("id", "crc", "bytes", "open").mapInArrow(_contexts(span, gram), _CONTEXT)
    contexts = common.written(contexts, "open-runs")
    crowded = contexts.groupBy("lead").count().where(F.col("count") > hot).select("lead")
    crowded = common.written(crowded, "hot-anchors")
    calm = contexts.join(crowded, "lead", "left_anti")
    parted = calm.repartitionByRange("lead").sortWithinPartitions("lead")
    found = parted.select(*(c.split()[0] for c in _CONTEXT.split(", "))).mapInArrow(_sorter(span), _REMOVED)
    found = found.unionByName(_hot_strings(contexts.join(crowded, "lead", "left_semi"), span))
    per_doc = found.groupBy("id", "crc").agg(F.collect_set(F.struct("start", "count")).alias("found"))
    settled = of_doc.where("settled IS NOT NULL").select("id", "crc", "settled")
    return common.written(settled.join(per_doc, ["id", "crc"], "full"), "repeated")


def _covered(n: int, settled: bytes | None, found: list | None, span: int) -> np.ndarray:
    edges = np.zeros(n + 1, np.int64)
    places = _places(settled)[:, :2]
    if found:
        places = np.concatenate([places, [(f["start"], f["count"]) for f in found]])
    np.add.at(edges, places[:, 0], 1)
    np.add.at(edges, places[:, 0] + places[:, 1] - 1 + span, -1)
    return np.cumsum(edges)[:n] > 0


def kept(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_bytes, removed, kept)``: removed as ``(start, end)``, and the bytes that are left."""
    schema = "doc_id long, n_bytes long, removed array<struct<start:int,end:int>>, kept binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                data = np.frombuffer(row["bytes"], np.uint8)
                gone = _covered(len(data), row["settled"], row["found"], span)
                edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                spans = [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
                rows.append((row["doc_id"], len(data), spans, data[~gone].tobytes()))
            columns = list(zip(*rows)) or [()] * 4
            span_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            kinds = (pa.int64(), pa.int64(), span_kind, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_bytes", "removed", "kept"]
            )

    gone = repeated(docs, span, gram)
    joined = _keyed(docs).join(gone, ["id", "crc"], "left")
    return joined.select(F.col("doc_id").cast("long"), "bytes", "settled", "found").mapInArrow(cut, schema)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kept(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
