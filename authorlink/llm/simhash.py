"""SimHash fingerprints, linked through BK-trees, and near-duplicates by similarity: components of links.

A bit of a fingerprint is set if it is set in over half of the hashes of a text's
word shingles. Fingerprints link if at most ``radius`` of their bits differ.

A BK-tree hangs every fingerprint below the first one of its shard, by edges named
with the distance to the parent; a search follows only edges whose name is within
the radius of the distance at hand. Trees over random fingerprints prune little, so
a tree for everything, sent to every query, would grow with the data and still be
searched nearly whole. Instead fingerprints are cut into blocks of 16 bits and the
shards are those that agree in one block; a fingerprint goes, by a shuffle, to the
tree of each of its blocks. With more blocks than ``radius`` no link is missed
(``radius`` differing bits leave one block untouched). ``near_duplicates`` links the
fingerprints of its sets of shingles in the same trees, and compares the sets of what is linked.

A shard above ``TILE`` fingerprints is dealt out to tiles; each pair of tiles is a
tree of one and the queries of the other, in its own group. Equal fingerprints are
one row, so a group of copies never meets in a task. A task reports links as a
spanning forest, no more of them than fingerprints, not as pairs.

Trees are built and searched level by level, for all shards in a task at once.

Defined cases. Texts without words (empty, null) have fingerprint zero and link
like any other. A text of fewer words than a shingle is one shingle. Repeated rows
have the same fingerprint. A null id counts for nothing in ``component_id``; it is
null only if no member has an id. An empty table gives an empty result. Very long
texts are hashed in parts. Extra columns are not carried along by ``linked``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from authorlink.llm import common
from authorlink.llm.components import components

SEED = 42
#: Most fingerprints of a shard in one tree, rows of links searched at a time, bytes of text hashed at a time.
TILE, FRONTIER, PART = 4096, 2_000_000, 1 << 20
#: Bytes of a block.
BLOCK = 2


def _word_parts(data: bytes, words: int) -> Iterator[list[bytes]]:
    """The words of a text in lists, each starting with the last ``words - 1`` of the list before."""
    kept: list[bytes] = []
    at = 0
    while at < len(data):
        end = at + PART
        while end < len(data) and not data[end : end + 1].isspace():
            end += 1
        found = kept + data[at:end].split()
        if len(found) >= words or end >= len(data):
            yield found
            kept = found[len(found) - words + 1 :] if words > 1 else []
        else:
            kept = found
        at = end


def _hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 of all shingles; letters A to Z count as small ones."""
    hash_, seen = xxhash.xxh64_intdigest, False
    for part in _word_parts((text or "").encode().lower(), words):
        if len(part) < words:
            if not seen and part:
                yield np.array([hash_(b" ".join(part), SEED)], np.uint64)
            continue
        seen = True
        joined = b" ".join(part)
        ends = np.cumsum([len(w) + 1 for w in part]).tolist()
        starts = [0, *ends[: len(part) - words]]
        yield np.array([hash_(joined[a : b - 1], SEED) for a, b in zip(starts, ends[words - 1 :])], np.uint64)


def _lanes(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """The hashes, and further ones mixed from them, side by side."""
    out = np.empty((len(hashes), lanes), np.uint64)
    out[:, 0] = hashes
    for lane in range(1, lanes):
        x = hashes + np.uint64((lane * 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, lane] = x ^ (x >> np.uint64(31))
    return out


def fingerprint(text: str | None, words: int, lanes: int = 1) -> bytes:
    """``8 * lanes`` bytes, the highest bit of a lane first."""
    return _majority(_hashes(text, words), lanes)


def _majority(parts: Iterable[np.ndarray], lanes: int = 1) -> bytes:
    """The bits set in over half of the hashes of all parts."""
    set_in, n = np.zeros(64 * lanes, np.int64), 0
    for hashes in parts:
        for at in range(0, len(hashes), 8192):
            some = _lanes(hashes[at : at + 8192], lanes).astype(">u8")
            bits = np.unpackbits(some.view(np.uint8).reshape(len(some), -1), axis=1)
            # Sums of 255 rows fit a byte, which adds up faster.
            for row in range(0, len(bits), 255):
                set_in += bits[row : row + 255].sum(0, dtype=np.uint8)
            n += len(some)
    return np.packbits(2 * set_in > n).tobytes()


def fingerprints(docs: DataFrame, words: int, lanes: int = 1) -> DataFrame:
    """``(doc_id, row, fp)`` of ``(doc_id, row, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), words, lanes) for text in batch.column("text")]
            columns = [batch.column("doc_id"), batch.column("row"), pa.array(prints, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "fp"])

    columns = docs.select(F.col("doc_id").cast("long"), "row", "text")
    return columns.mapInArrow(run, "doc_id long, row long, fp binary")


def _distance(prints: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differing = np.bitwise_count(prints[a] ^ prints[b])
    return differing.sum(1, dtype=np.int32) if prints.shape[1] > 1 else differing[:, 0].astype(np.int32)


class Forest:
    """A BK-tree for every group of distinct fingerprints; ``group`` ascends."""

    def __init__(self, prints: np.ndarray, group: np.ndarray):
        n = len(group)
        self.prints = prints
        self.edge = np.zeros(n, np.int32)
        parent = np.full(n, -1, np.int64)
        first = np.flatnonzero(np.diff(group, prepend=group[0] - 1) != 0) if n else np.zeros(0, np.int64)
        self.root_of_group = dict(zip(group[first].tolist(), first.tolist()))
        root = np.repeat(first, np.diff(first, append=n))
        waiting = np.flatnonzero(np.arange(n) != root)
        at = root[waiting]
        while len(waiting):
            d = _distance(prints, waiting, at)
            _, place, edge_of = np.unique(at * (64 * prints.shape[1] + 1) + d, return_index=True, return_inverse=True)
            child = waiting[place]
            parent[child], self.edge[child] = at[place], d[place]
            rest = np.ones(len(waiting), bool)
            rest[place] = False
            at, waiting = child[edge_of[rest]], waiting[rest]
        self.children = np.argsort(parent, kind="stable")[len(first) :]
        counts = np.bincount(parent[self.children], minlength=n) if n else np.zeros(0, np.int64)
        self.count, self.start = counts, np.cumsum(counts) - counts

    def search(self, prints: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) within the radius, level by level."""
        query, node = np.arange(len(prints)), roots
        while len(query):
            differing = np.bitwise_count(prints[query] ^ self.prints[node])
            d = differing.sum(1, dtype=np.int32)
            near = d <= radius
            yield query[near], node[near]
            count = self.count[node]
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            child = self.children[np.repeat(self.start[node], count) + place]
            follow = np.abs(self.edge[child] - np.repeat(d, count)) <= radius
            query, node = np.repeat(query, count)[follow], child[follow]


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking a with b: every node's is the least place it is known to reach."""
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return label
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _links_of(group: np.ndarray, low: np.ndarray, high: np.ndarray, tile: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in every group, as places."""
    n = len(group)
    label = np.arange(n)
    held = np.flatnonzero(tile == high)
    asking = np.flatnonzero(tile == low)
    forest = Forest(prints[held], group[held])
    rooted = np.array([forest.root_of_group.get(g, -1) for g in group[asking].tolist()], np.int64)
    asking, rooted = asking[rooted >= 0], rooted[rooted >= 0]
    sizes = np.bincount(group[held], minlength=int(group.max(initial=0)) + 1)[group[asking]]
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // FRONTIER)) + 1
    for part in np.split(np.arange(len(asking)), cuts):
        for query, node in forest.search(prints[asking[part]], rooted[part], radius):
            a, b = asking[part][query], held[node]
            label = _joined(label, a[a != b], b[a != b])
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def _linker(radius: int, lanes: int, rows_at_once: int = 100_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []
        for batch in batches:
            kept.append(pa.Table.from_batches([batch]))
            if sum(map(len, kept)) >= rows_at_once:
                table = pa.concat_tables(kept).combine_chunks()
                change = _changes(table)
                cut = int(np.flatnonzero(change)[-1]) if change[1:].any() else 0
                if cut:
                    yield from linked(table.slice(0, cut).combine_chunks())
                kept = [table.slice(cut)]
        if kept:
            yield from linked(pa.concat_tables(kept).combine_chunks())

    def linked(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not len(table):
            return
        column = {c: table[c].to_numpy() for c in ("low", "high", "tile")}
        raw = b"".join(table["fp"].to_pylist())
        prints = np.frombuffer(raw, np.uint64).reshape(-1, lanes)
        group = np.cumsum(_changes(table))
        a, b = _links_of(group, column["low"], column["high"], column["tile"], prints, radius)
        fp = table["fp"].combine_chunks()
        yield pa.RecordBatch.from_arrays([fp.take(pa.array(a)), fp.take(pa.array(b))], ["a", "b"])

    return run


def _changes(table: pa.Table) -> np.ndarray:
    """Where a new group starts."""
    change = np.zeros(len(table), bool)
    change[:1] = True
    for c in ("block", "value", "low", "high"):
        x = table[c].to_numpy()
        change[1:] |= x[1:] != x[:-1]
    return change


def links(distinct: DataFrame, radius: int, lanes: int = 1, tile: int = TILE) -> DataFrame:
    """Links ``(a, b)`` of distinct fingerprints ``fp`` that reach all that can be reached."""
    blocks = F.expr(f"transform(sequence(0, {8 * lanes // BLOCK - 1}), b -> conv(hex(substring(fp, {BLOCK} * b + 1, {BLOCK})), 16, 10))")
    sharded = distinct.select("fp", F.posexplode(blocks).alias("block", "value"))
    sharded = sharded.withColumn("value", F.col("value").cast("int"))
    sizes = sharded.groupBy("block", "value").count().where(F.col("count") > tile)
    hot = common.written(sizes.select("block", "value", F.ceil(F.col("count") / tile).cast("int").alias("tiles")), "hot-shards")
    n_hot = hot.count()
    if n_hot:
        # At most one row for each value of each block; over a size it is joined by a shuffle.
        tiled = sharded.join(F.broadcast(hot) if n_hot <= 100_000 else hot, ["block", "value"], "left")
        tiled = tiled.withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    else:
        tiled = sharded.withColumn("tiles", F.lit(1))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("fp"), "tiles").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    paired = tiled.withColumn("other", other).select(
        "block", "value", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "fp"
    )
    key = ["block", "value", "low", "high"]
    found = paired.repartition(*key).sortWithinPartitions(*key, "fp").mapInArrow(_linker(radius, lanes), "a binary, b binary")
    return found.distinct()


def groups(docs: DataFrame, words: int, radius: int, lanes: int = 1, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """Fingerprints ``(doc_id, row, fp)`` of documents ``(doc_id, row, text)``, and ``(fp, root)`` of every fingerprint."""
    printed = common.written(fingerprints(docs, words, lanes), "fingerprints")
    distinct = common.written(printed.select("fp").distinct(), "distinct-fingerprints")
    found = components(links(distinct, radius, lanes, tile), "a", "b")
    joined = distinct.join(found, distinct["fp"] == found["node"], "left")
    return printed, joined.select("fp", F.coalesce("root", "fp").alias("root"))


def linked(docs: DataFrame, words: int, radius: int, lanes: int = 1, tile: int = TILE) -> DataFrame:
    """``(doc_id, fp, component_id)`` of documents ``(doc_id, text)``."""
    printed, member = groups(docs.withColumn("row", F.lit(0).cast("long")), words, radius, lanes, tile)
    first = printed.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    known = common.written(member.join(first, "fp"), "members")
    least = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = known.join(least, "root").select("fp", "component_id")
    return printed.join(of_fp, "fp").select("doc_id", "fp", "component_id")


#: Near-duplicates: words of a shingle, and the least similarity of a link.
NEAR_WORDS, NEAR_SHARE = 5, 0.8
#: Differing bits of fingerprints whose sets are compared.
NEAR_RADIUS = 3
#: The texts and the characters that are compared in one group at most.
NEAR_TILE, NEAR_CHARS = 2048, 16_000_000
#: Hashes of texts that are held at a time, or those of one text.
AT_ONCE = 50_000
#: Share of a set's hashes that are looked up beyond what a similar set may lack; more of them let fewer sets pass.
NEAR_SLACK = 0.1


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct hashes of all shingles, ascending: a shingle counts once, however often it is repeated."""
    kept, parts, waiting = np.zeros(0, np.uint64), [], 0
    for hashes in _hashes(text, words):
        parts.append(np.unique(hashes))
        waiting += len(parts[-1])
        # Parts of very long texts are merged as often as what is kept doubles.
        if waiting > len(kept):
            kept, parts, waiting = np.unique(np.concatenate([kept, *parts])), [], 0
    return np.unique(np.concatenate([kept, *parts])) if parts else kept


def _sets(texts: pa.Array, words: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The sets of shingles of all texts, some at a time, with the place of the first."""
    at, sets, waiting = 0, [], 0
    for i, text in enumerate(texts):
        sets.append(shingle_set(text.as_py(), words))
        waiting += len(sets[-1])
        if i + 1 == len(texts) or waiting >= AT_ONCE:
            yield at, sets
            at, sets, waiting = i + 1, [], 0


def _shared(size: int, share: float) -> int:
    """Hashes that a set of ``size`` shares at least with any that has a Jaccard similarity of ``share`` to it."""
    return math.ceil(share * size - 1e-6)


def _lookup(size: int, share: float) -> tuple[int, int]:
    """How many of a set's least hashes are looked up, and how many of them it shares with any similar set's.

    A similar set lacks ``size - _shared`` hashes at most, so of as many and ``more`` it has ``more``. What two sets share
    stands in the same order in both; so they have the lesser of their two numbers in common, and
    the smallest set that may be similar has ``_shared`` hashes.
    """

    def more(n: int) -> int:
        return min(_shared(n, share), max(1, math.ceil(NEAR_SLACK * n)))

    return size - _shared(size, share) + more(size), more(_shared(size, share))


def _shingled(docs: DataFrame, words: int, share: float) -> DataFrame:
    """``(doc_id, row, key, fp, chars, enough, least)`` of ``(doc_id, row, text)``; equal sets of shingles have the same key.

    The fingerprint is that of the set: a shingle counts once. ``least`` has the hashes that are looked up, and ``enough``
    is how many of them have to be found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in _sets(batch.column("text"), words):
                some = batch.slice(at, len(sets))
                lookups = [_lookup(len(hashes), share) for hashes in sets]
                least = [hashes[:n].view(np.int64) for hashes, (n, _) in zip(sets, lookups)]
                columns = {
                    "doc_id": some.column("doc_id"),
                    "row": some.column("row"),
                    "key": pa.array([xxhash.xxh3_128_digest(hashes.tobytes()) for hashes in sets], pa.binary()),
                    "fp": pa.array([_majority([hashes]) for hashes in sets], pa.binary()),
                    "chars": pc.fill_null(pc.utf8_length(some.column("text")), 0).cast(pa.int64()),
                    "enough": pa.array([enough for _, enough in lookups], pa.int64()),
                    "least": pa.ListArray.from_arrays(np.cumsum([0, *map(len, least)], dtype=np.int32), np.concatenate(least)),
                }
                yield pa.RecordBatch.from_pydict(columns)

    columns = docs.select(F.col("doc_id").cast("long"), "row", "text")
    return columns.mapInArrow(run, "doc_id long, row long, key binary, fp binary, chars long, enough long, least array<long>")


def _found_elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(of, n)``: how often a set had a hash that another one has too, of distinct rows ``(hash, of)`` in order."""
    last = None
    for batch in batches:
        hashes, of = batch.column("hash").to_numpy(), batch.column("of").to_numpy()
        if last is not None:
            # The last row before is told of only once its successor is known.
            hashes, of = np.append(last[0], hashes), np.append(last[1], of)
        new = np.ones(len(of), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
        hashes, of = hashes[new], of[new]
        same = hashes[1:] == hashes[:-1]
        met = np.append(last is not None and last[2], same)
        met[:-1] |= same
        if len(of):
            last = hashes[-1], of[-1], met[-1]
            sets, n = np.unique(of[:-1][met[:-1]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.int64()), pa.array(n, pa.int64())], ["of", "n"])
    if last is not None and last[2]:
        yield pa.RecordBatch.from_arrays([pa.array([last[1]], pa.int64()), pa.array([1], pa.int64())], ["of", "n"])


def _maybe_similar(printed: DataFrame, distinct: DataFrame) -> DataFrame:
    """The keys of sets that share enough of their least hashes with others. No other set is similar to one."""
    looked_up = printed.select(F.explode("least").alias("hash"), F.xxhash64("key").alias("of"))
    found = looked_up.repartition("hash").sortWithinPartitions("hash", "of").mapInArrow(_found_elsewhere, "of long, n long")
    found = found.groupBy("of").agg(F.sum("n").alias("n"))
    return distinct.join(found, F.xxhash64("key") == F.col("of")).where("n >= enough").select("key")


def _rarest(suspects: DataFrame, words: int, share: float) -> DataFrame:
    """``(key, rare)``: hashes of which similar sets have one in common.

    Of a set's hashes, the rarest first, a similar one lacks ``size - _shared`` at most, and they share the first of those they share.
    Hashes that no other suspect has come first, and need no mention.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in _sets(batch.column("text"), words):
                sizes = [len(hashes) for hashes in sets]
                keys = batch.column("key").take(pa.array(np.repeat(np.arange(at, at + len(sets)), sizes)))
                shared = np.repeat(np.array([_shared(n, share) for n in sizes], np.int64), sizes)
                columns = [keys, pa.array(np.concatenate(sets).view(np.int64)), pa.array(shared)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "hash", "shared"])

    held = suspects.select("key", "text").mapInArrow(run, "key binary, hash long, shared long")
    counted = held.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("hash"))).where("n > 1")
    of_set = counted.groupBy("key").agg(F.first("shared").alias("shared"), F.sort_array(F.collect_list(F.struct("n", "hash"))).alias("held"))
    rare = F.slice("held", F.lit(1), (F.size("held") - F.col("shared") + 1).cast("int"))
    return of_set.where(F.size("held") >= F.col("shared")).select("key", rare["hash"].alias("rare"))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every key with the one before it, where both have the hash, of rows in the order of hashes."""
    last_hash, last_key = None, None
    for batch in batches:
        a, b = [], []
        for hash_, key in zip(batch.column("hash").to_pylist(), batch.column("key").to_pylist()):
            if hash_ == last_hash:
                a.append(last_key)
                b.append(key)
            last_hash, last_key = hash_, key
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _similar(
    sets: list[np.ndarray], of_text: list[list[int]], prints: np.ndarray, tile: np.ndarray, across: bool, share: float
) -> list[tuple[int, int]]:
    """Links, as places, that connect all sets connected by pairs with a Jaccard similarity of ``share``.

    Of the pairs with a rare hash in common or with fingerprints within ``NEAR_RADIUS``.
    """
    n, found = len(sets), []
    size = np.array([len(s) for s in sets])
    label, tried = np.arange(n), np.zeros((n, n), bool)
    place = np.repeat(np.arange(n), [len(rare) for rare in of_text])
    rare = np.array([x for hashes in of_text for x in hashes], np.int64)
    order = np.argsort(rare, kind="stable")

    def met() -> Iterator[tuple[int, np.ndarray]]:
        for members in np.split(place[order], np.flatnonzero(np.diff(rare[order])) + 1):
            # What is connected needs no comparison.
            if len(members) and (label[members] != label[members[0]]).any():
                yield from ((members[at], members[:at]) for at in range(1, len(members)))
        for x in range(1, n):
            yield x, np.flatnonzero(np.bitwise_count(prints[:x] ^ prints[x]) <= NEAR_RADIUS)

    for x, near in met():
        near = near[(label[near] != label[x]) & ~tried[x, near]]
        near = near[np.minimum(size[near], size[x]) >= share * np.maximum(size[near], size[x]) - 1e-6]
        for y in (near[tile[near] != tile[x]] if across else near).tolist():
            if label[y] == label[x]:
                continue
            tried[x, y] = True
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if both / (size[x] + size[y] - both) >= share:
                found.append((y, int(x)))
                label[label == label[x]] = label[y]
    return found


def _verifier(words: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, rows = None, []
        for batch in batches:
            columns = [batch.column(c) for c in ("root", "low", "high", "tile", "key", "fp", "rare", "text")]
            for i in range(batch.num_rows):
                *group, tile, key, fp, of_text, text = (c[i].as_py() for c in columns)
                if group != of:
                    yield from linked(of, rows)
                    of, rows = group, []
                rows.append((tile, key, fp, of_text, shingle_set(text, words)))
        yield from linked(of, rows)

    def linked(of: list | None, rows: list) -> Iterator[pa.RecordBatch]:
        if len(rows) > 1:
            tile, key, fp, of_text, sets = zip(*rows)
            prints = np.frombuffer(b"".join(fp), np.uint64)
            found = _similar(list(sets), list(of_text), prints, np.array(tile), of[1] != of[2], share)
            columns = [pa.array([key[pair[k]] for pair in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return run


def _near_prints(distinct: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of keys that connect all whose fingerprints the BK-trees link, equal ones included."""
    firsts = common.written(distinct.groupBy("fp").agg(F.min("key").alias("first_key")), "near-prints")
    one, other = (firsts.withColumnsRenamed({"fp": c, "first_key": f"{c}_key"}) for c in "ab")
    across = links(firsts.select("fp"), NEAR_RADIUS).join(one, "a").join(other, "b")
    equal = distinct.select("fp", "key").join(firsts, "fp").where("key <> first_key")
    across = across.select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))
    return across.unionByName(equal.select(F.col("first_key").alias("a"), F.col("key").alias("b")))


def _similar_keys(docs: DataFrame, printed: DataFrame, distinct: DataFrame, words: int, share: float, tile: int) -> DataFrame:
    """Links ``(a, b)`` of keys, all of them confirmed, that reach all that can be reached."""
    near = common.written(_near_prints(distinct), "near-links")
    asked = near.select(F.col("a").alias("key")).unionByName(near.select(F.col("b").alias("key"))).unionByName(_maybe_similar(printed, distinct)).distinct()
    known = distinct.join(asked, "key").select("key", "fp", "chars", F.col("first.doc_id").alias("_id"), F.col("first.row").alias("_row"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))
    # A row may be there more than once.
    suspects = docs.select("doc_id", "row", "text").join(known, same).groupBy("key").agg(*(F.first(c).alias(c) for c in ("fp", "chars", "text")))
    suspects = common.written(suspects, "suspects")
    rare = common.written(_rarest(suspects, words, share), "rare-hashes")
    held = rare.select("key", F.explode("rare").alias("hash"))
    chained = held.repartition("hash").sortWithinPartitions("hash", "key").mapInArrow(_neighbours, "a binary, b binary")
    member = components(chained.unionByName(near).distinct(), "a", "b").withColumnRenamed("node", "key")
    candidates = common.written(suspects.select("key", "chars").join(member, "key"), "candidates")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / tile), F.ceil(F.sum("chars") / NEAR_CHARS)).cast("int")
    tiled = candidates.join(candidates.groupBy("root").agg(parts.alias("tiles")), "root")
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("key"), "tiles").cast("int")).select("root", "tiles", "tile", "key")
    with_text = suspects.join(tiled, "key").join(rare, "key", "left").withColumn("rare", F.coalesce("rare", F.array().cast("array<long>")))
    paired = with_text.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "root", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "key", "fp", "rare", "text"
    )
    group = ["root", "low", "high"]
    return paired.repartition(*group).sortWithinPartitions(*group, "key").mapInArrow(_verifier(words, share), "a binary, b binary")


def near_duplicates(docs: DataFrame, words: int = NEAR_WORDS, share: float = NEAR_SHARE, tile: int = NEAR_TILE) -> DataFrame:
    """The documents without near-duplicates: of each group the one with the lowest id stays.

    Groups are the components of links between texts whose sets of shingles have a
    Jaccard similarity of ``share`` or more; each link is confirmed by the sets
    themselves, and no such pair is missed. Pairs are compared if their fingerprints, linked through the BK-trees, differ in
    at most ``NEAR_RADIUS`` bits, or if the sets have one of their rarest hashes in common, as any two so similar do. Few
    texts come that far: a set that shares too few of its least hashes with others is similar to none (``_lookup``), and only
    the texts of the other sets move and have all of their hashes counted.

    Texts so connected form candidate groups. Large groups are
    dealt out to tiles, each pair of which is compared in a group of its own; pairs that are
    connected already are not compared. Texts without words are one group.
    Ids come before null ones; of equal ids the row with the lowest hash stays, and of
    equal rows one. Further columns, of any name, are returned as they are.
    """
    names = docs.columns
    docs = docs.withColumnsRenamed({c: f"_of_{i}_{c}" for i, c in enumerate(names) if c not in ("doc_id", "text")})
    columns = docs.columns
    row = F.xxhash64(*(F.col(c) for c in columns))
    numbered = docs.select("doc_id", row.alias("row"), "text")
    printed = common.written(_shingled(numbered, words, share), "shingled")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    distinct = printed.groupBy("key").agg(F.min(key).alias("first"), *(F.first(c).alias(c) for c in ("fp", "chars", "enough")))
    distinct = common.written(distinct, "distinct-sets")
    found = components(_similar_keys(numbered, printed, distinct, words, share, tile), "a", "b")
    member = distinct.join(found, distinct["key"] == found["node"], "left").select("first", F.coalesce("root", "key").alias("root"))
    chosen = member.groupBy("root").agg(F.min("first").alias("first"))
    chosen = chosen.select(F.col("first.doc_id").alias("_id"), F.col("first.row").alias("_row"))
    copies = printed.groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("_n"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))
    chosen = common.written(chosen.join(copies, same).select("_id", "_row", "_n"), "chosen")
    kept = docs.withColumn("row", row).join(chosen, same)
    # Rows that are there more than once, in all columns, are rare: only those are made distinct.
    single = kept.where("_n = 1").select(*columns)
    if chosen.where("_n > 1").limit(1).count():
        single = single.unionByName(kept.where("_n > 1").select(*columns).distinct())
    return single.toDF(*names)


def op6_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    out = linked(docs, words=3, radius=3)
    return out.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")
