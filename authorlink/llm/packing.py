"""Best-fit packing of token sequences by hierarchical residual rounds.

Documents become token ids. Documents longer than a sequence are cut into whole
pieces and one shorter piece, which comes first. Whole pieces are sequences by
themselves. The shorter pieces are items:

1. Items are spread over buckets by hash. A task packs its bucket best-fit, the
   longest items first, and emits the nearly full bins.
2. Bins that are not nearly full become items, with their content, for the next
   round, in a fraction (``fan_in``) as many buckets. Opening such a bin again costs
   little: it is packed as one item.
3. Rounds end when the bins fit one bucket, or when a round no longer lowers their
   number by ``least_gain``: long items that nothing can join would otherwise all
   meet in one task. What is left is emitted as it is.

Only lengths and checksums move; a bin holds at most ``capacity`` pieces. Each round
is written to the shared folder, so a lost executor costs its tasks of one round.

Token ids come from the ``tokenizers`` library. Texts are cut before single spaces,
where this tokenizer's own rule always cuts, and each distinct piece is encoded
once a task's memory of them (``memory`` pieces) holds it. ``tests/llm`` compares the
ids with those of whole texts.

Defined cases. A null or empty text is the end id alone. Repeated rows and ids
are each packed. An empty table gives an empty result. Very long texts are many
pieces. Extra columns are not carried along.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authorlink.llm import common

CAPACITY, END = 1024, 2
#: Items in a bucket, buckets that meet in one of the next round, and the fall in bins that is worth another round.
BUCKET, FAN_IN, LEAST_GAIN = 50_000, 8, 0.002
#: A bin with at most this much room left is nearly full.
SLACK = 2
#: Pieces and words that a task remembers, each of at most LONGEST characters.
MEMORY, LONGEST = 1_000_000, 64

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_MEMBERS = "array<struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
_BIN = f"bucket long, place int, size int, members {_MEMBERS}"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Of a piece of text between single spaces: the tokenizer's own words.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Ids of texts as bytes, four for each id (little-endian); remembers pieces and words it has seen."""

    def __init__(self, path: str, memory: int = MEMORY):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._model = self._whole.model
        self._memory = memory
        self._known: dict[str, bytes] = {}
        self._signs = _byte_signs()
        self._find = regex.compile(_WORDS).findall
        # White space after a space, or at its end, belongs to a longer run: such texts are encoded whole.
        self._odd = regex.compile(r" (?:\s|\Z)").search
        # Letters whose class no version of Unicode has changed; pieces with others are encoded as the library does.
        self._plain = regex.compile(r"[\n\x20-\x7e\xa1-\xa9\xab-\xb1\xb4-\xb8\xbb\xbf-ɏ]*").fullmatch
        self._special = [t.content for t in self._whole.get_added_tokens_decoder().values()]

    def _direct(self, text: str) -> bytes:
        ids = self._whole.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _keep(self, text: str, ids: bytes) -> bytes:
        if len(text) <= LONGEST:
            if len(self._known) >= self._memory:
                self._known.clear()
            self._known[text] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """A word of the tokenizer's own rule."""
        tokens = self._model.tokenize(word.encode().decode("latin-1").translate(self._signs))
        return self._keep(word, struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens]))

    def _piece(self, piece: str) -> bytes:
        if not self._plain(piece):
            return self._keep(piece, self._direct(piece))
        if piece[piece[0] == " " :].isalpha():
            return self._word(piece)
        known, word = self._known.get, self._word
        return self._keep(piece, b"".join([known(w) or word(w) for w in self._find(piece)]))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self._odd(text) or any(s in text for s in self._special):
            return self._direct(text)
        first, *rest = text.split(" ")
        known, piece = self._known.get, self._piece
        out = [known(first) or piece(first)] if first else []
        for p in rest:
            p = " " + p
            out.append(known(p) or piece(p))
        return b"".join(out)


def _byte_signs() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a printable sign: itself, or one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces_of(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int]]:
    """``(start, length, crc32)`` of a document's pieces: a shorter one first, then whole ones."""
    n = len(ids) // 4
    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
    return [(a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for a, b in zip(cuts, cuts[1:])]


def tokenised(docs: DataFrame, tokenizer: str | None = None, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents ``(doc_id, text)``."""
    path = tokenizer or default_tokenizer()
    last = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path).encode
        for batch in batches:
            rows, places = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = pieces_of(encode(text or "") + last, capacity)
                places += [i] * len(found)
                rows += [(p, *piece) for p, piece in enumerate(found)]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(places, pa.int64())), pa.array(columns[0], pa.int32())]
                + [pa.array(column, pa.int64()) for column in columns[1:]],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, _PIECE)


def best_fit(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Places of the sizes by bin: longest first, each into the fullest bin with room for it."""
    bins: list[list[int]] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r left
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = rooms >> sizes[i]
        if fits:
            room = sizes[i] + (fits & -fits).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        left = room - sizes[i]
        if left:
            with_room[left].append(b)
            rooms |= 1 << left
    return bins


def _packed(capacity: int):
    def pack(bucket: pd.DataFrame) -> pd.DataFrame:
        # The order of rows within a group is not fixed; a repeated task must make the same bins.
        bucket = bucket.assign(key=[[tuple(m.values()) for m in ms] for ms in bucket["members"]])
        bucket = bucket.iloc[sorted(range(len(bucket)), key=lambda i: repr(bucket["key"].iat[i]))]
        sizes, members = bucket["size"].tolist(), bucket["members"].tolist()
        bins = best_fit(sizes, capacity)
        return pd.DataFrame(
            {
                "bucket": bucket["bucket"].iloc[0],
                "place": np.arange(len(bins), dtype=np.int32),
                "size": [sum(sizes[i] for i in b) for b in bins],
                "members": [[m for i in b for m in members[i]] for b in bins],
            }
        )

    return pack


def packed(pieces: DataFrame, capacity: int = CAPACITY, bucket: int = BUCKET, fan_in: int = FAN_IN, slack: int = SLACK, least_gain: float = LEAST_GAIN) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    pieces = common.written(pieces, "pieces")
    whole = pieces.where(F.col("length") >= capacity - slack)
    own_id = F.monotonically_increasing_id()  # directly on a scan of a written table
    done = [whole.withColumn("sequence_id", own_id).withColumn("offset", F.lit(0).cast("long"))]
    member = F.struct(*(c.split()[0] for c in _PIECE.split(", ")))
    items = pieces.where(F.col("length") < capacity - slack).select(
        F.col("length").cast("int").alias("size"), F.array(member).alias("members")
    )
    n, round_ = items.count(), 0
    buckets = common.tasks_for(n, bucket)
    while n:
        round_ += 1
        spread = F.pmod(F.xxhash64(F.lit(round_), "members"), F.lit(buckets)).alias("bucket")
        bins = items.select(spread, "size", "members").groupBy("bucket").applyInPandas(_packed(capacity), _BIN)
        bins = common.written(bins, f"bins-{round_}")
        nearly_full = F.col("size") >= capacity - slack
        n_left = bins.where(~nearly_full).count()
        if buckets == 1 or n_left > n * (1 - least_gain):
            done.append(_sequences(bins, round_))
            break
        done.append(_sequences(bins.where(nearly_full), round_))
        items, n = bins.where(~nearly_full).select("size", "members"), n_left
        buckets = max(common.tasks_for(n, bucket), -(-buckets // fan_in))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _sequences(bins: DataFrame, round_: int) -> DataFrame:
    """One row per piece; ids of sequences are unique over buckets and rounds."""
    sequence = F.lit(round_ << 58) + F.col("bucket") * F.lit(1 << 24) + F.col("place")
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("offsets"))
    offsets = F.aggregate(
        "members",
        first,
        lambda s, m: F.struct((s["at"] + m["length"]).alias("at"), F.concat(s["offsets"], F.array(s["at"])).alias("offsets")),
    )["offsets"]
    placed = bins.select(sequence.alias("sequence_id"), F.explode(F.arrays_zip("members", offsets.alias("offset"))).alias("m"))
    return placed.select("m.members.*", "sequence_id", "m.offset")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    return packed(tokenised(docs))
