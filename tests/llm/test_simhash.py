from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from authorlink.llm import simhash
from authorlink.llm.components import components
from tests.llm.conftest import rows_of
from tests.llm.texts import documents, prose


def _print(text, words=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, seed=42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def _roots(prints, radius):
    roots = list(range(len(prints)))
    for _ in prints:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= radius:
                    roots[i] = roots[j] = min(roots[i], roots[j])
    return roots


def _check(spark, folder, docs):
    out = rows_of(simhash.op6_simhash_components(spark, folder(docs, extra=True)))
    prints = [_print(d[1]) for d in docs]
    roots = _roots(prints, 3)
    want = []
    for d, p, r in zip(docs, prints, roots):
        ids = [e[0] for e, q in zip(docs, roots) if q == r and e[0] is not None]
        want.append((d[0], f"{p:016x}", min(ids, default=None)))
    assert sorted(out, key=repr) == sorted(want, key=repr)
    return len(set(roots))


def test_edge_cases(spark, folder):
    docs = [d if d[0] != 8 else (8, d[1][:9000], *d[2:]) for d in documents()]
    _check(spark, folder, docs)


def test_chains_of_near_copies(spark, folder):
    r = random.Random(4)
    docs = []
    for k in range(4):
        words = prose(400, 50 + k).split()
        for i in range(15):
            words[r.randrange(len(words))] = f"w{k}{i}"
            docs.append((r.randrange(10**9), " ".join(words)))
    assert _check(spark, folder, docs) < len(docs)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = prose(900, 8)
    whole = simhash.fingerprint(text, 3)
    monkeypatch.setattr(simhash, "PART", 64)
    assert simhash.fingerprint(text, 3) == whole == _print(text).to_bytes(8, "big")


@pytest.mark.parametrize("lanes", [1, 2])
@pytest.mark.parametrize("tile", [7, 10_000])
def test_forest_finds_what_comparing_all_finds(spark, lanes, tile):
    r = np.random.default_rng(3)
    base = r.integers(0, 2**63, (6, lanes), dtype=np.uint64)
    prints = []
    for _ in range(90):
        p = base[r.integers(6)].copy()
        for _ in range(r.integers(6)):
            p[r.integers(lanes)] ^= np.uint64(1 << int(r.integers(64)))
        prints.append(p.astype(">u8").tobytes())
    prints = sorted(set(prints))
    df = spark.createDataFrame([(bytearray(p),) for p in prints], "fp binary")
    found = components(simhash.links(df, 3, lanes, tile), "a", "b")
    root = {bytes(r.node): bytes(r.root) for r in found.collect()}
    whole = [int.from_bytes(p, "big") for p in prints]
    roots = _roots(whole, 3)
    assert [root.get(p, p) for p in prints] == [prints[i] for i in roots]


def test_components_of_chains_rings_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (5, 5)] + [(200, 300 + i) for i in range(30)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b")
    assert dict(rows_of(found)) == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100), 200: 200, **{300 + i: 200 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_near_duplicates_keep_one_of_each_group(spark, folder):
    docs = documents()
    sf = folder(docs, extra=True)
    read = spark.read.parquet(f"{sf}/documents.parquet")
    out = simhash.near_duplicates(read)
    assert out.columns == read.columns
    kept = [r.doc_id for r in out.collect()]
    # 1, 2 and 3 are near-copies, 12 has the text of the one without id, 4, 5 and 6 have no words, 8 is there twice.
    assert sorted(kept, key=repr) == sorted([1, 4, 7, 8, 9, 10, 11, 12, 13, -5, 2**60], key=repr)


def _set_of(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def _pair(n, changed, seed):
    """Texts of which the second has other words at the end, for ``changed`` shingles."""
    r = random.Random(seed)
    first = [f"w{r.getrandbits(40)}" for _ in range(n)]
    return " ".join(first), " ".join(first[: n - changed] + [f"v{r.getrandbits(40)}" for _ in range(changed)])


@pytest.mark.parametrize("tile", [simhash.NEAR_TILE, 1])
def test_isolated_pairs_are_linked_by_their_similarity_alone(spark, folder, tile):
    docs, want = [], set()
    for i in range(240):
        n = 64 + i
        # The union has n - 4 + changed shingles: similarities of 0.75 to just below 0.8, and of 0.8 to 0.83.
        changed = (n - 4) // 9 if i % 2 else (n - 4) // 9 + 1 + i % 3
        a, b = _pair(n, changed, i)
        shared, all_ = len(_set_of(a) & _set_of(b)), len(_set_of(a) | _set_of(b))
        docs += [(2 * i, a), (2 * i + 1, b)]
        want |= {2 * i} if shared / all_ >= 0.8 else {2 * i, 2 * i + 1}
    assert 330 < len(want) < 390
    read = spark.read.parquet(f"{folder(docs)}/documents.parquet")
    assert {r.doc_id for r in simhash.near_duplicates(read, tile=tile).collect()} == want


def test_repeated_lines_count_once(spark, folder):
    line = " ".join(f"l{i}" for i in range(16))
    docs = []
    for i in range(0, 40, 4):
        # Unrelated but for a line repeated 20 times; then a text, and its copy with the line appended 10 times.
        (a, b), (text, _) = _pair(304, 304, 100 + i), _pair(304, 0, 200 + i)
        docs += [(i, f"{a} {' '.join([line] * 20)}"), (i + 1, f"{b} {' '.join([line] * 20)}")]
        docs += [(i + 2, text), (i + 3, f"{text} {' '.join([line] * 10)}")]
    read = spark.read.parquet(f"{folder(docs)}/documents.parquet")
    assert {r.doc_id for r in simhash.near_duplicates(read).collect()} == {d[0] for d in docs if d[0] % 4 != 3}


def test_sets_of_long_texts_in_parts(monkeypatch):
    text = f"{prose(3000, 8)} {prose(500, 9)} {prose(500, 9)} é"
    want = sorted({xxhash.xxh64_intdigest(s.encode(), simhash.SEED) for s in _set_of(text)})
    assert simhash.shingle_set(text, 5).tolist() == want
    monkeypatch.setattr(simhash, "PART", 64)
    assert simhash.shingle_set(text, 5).tolist() == want


def test_empty_table(spark, folder):
    sf = folder([])
    assert simhash.op6_simhash_components(spark, sf).count() == 0
    assert simhash.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet")).count() == 0


def test_fingerprints_near_each_other_are_compared_without_a_common_band(spark):
    rng = np.random.default_rng(5)
    base, other = (np.unique(rng.integers(0, 2**64, 500, np.uint64)) for _ in range(2))
    sets = [base, base[3:], other]
    prints = np.array([7, 7 ^ 0b101, 7 ^ 0b111], np.uint64)
    # All three are near each other, but only two sets are alike.
    assert simhash._similar(sets, [[], [], []], prints, np.zeros(3, int), False, 0.8) == [(0, 1)]
    far = np.array([7, 7 ^ 0xF0, 7], np.uint64)
    assert simhash._similar(sets, [[], [], []], far, np.zeros(3, int), False, 0.8) == []


def test_near_prints_connect_keys_through_the_trees(spark):
    prints = {b"a": 5, b"b": 5, b"c": 5 ^ 0b11, b"d": 5 ^ 0b11111, b"e": 5 ^ 0xFFFF00}
    rows = [(bytearray(key), bytearray(fp.to_bytes(8, "big"))) for key, fp in prints.items()]
    found = simhash._near_prints(spark.createDataFrame(rows, "key binary, fp binary"))
    # d is within three bits of c alone, and e of none.
    of = {bytes(r.node): bytes(r.root) for r in components(found, "a", "b").collect()}
    assert of == dict.fromkeys([b"a", b"b", b"c", b"d"], b"a")


def _alike(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def test_a_pair_without_a_common_run_of_least_hashes_is_found(spark, folder):
    # The former way, 30 bands of 5 least hashes, finds nothing: of each band, the text of one least hash is changed.
    words = _pair(2000, 0, 77)[0].split()
    mix = np.random.default_rng(42).integers(0, 2**64, (2, 150), np.uint64) | np.array([[1], [0]], np.uint64)

    def least(words):
        hashes = np.array([xxhash.xxh64_intdigest(" ".join(words[i : i + 5]), 42) for i in range(len(words) - 4)], np.uint64)
        mixed = hashes[:, None] * mix[0] + mix[1]
        return mixed.min(0).reshape(30, 5), mixed.argmin(0)

    (before, places), other = least(words), list(words)
    for place in places[::5].tolist():
        other[place + 2] = f"x{place}"
    assert not (least(other)[0] == before).all(1).any()
    a, b = " ".join(words), " ".join(other)
    assert 0.8 < len(_set_of(a) & _set_of(b)) / len(_set_of(a) | _set_of(b)) < 0.9
    prints = (int.from_bytes(simhash._majority([simhash.shingle_set(x, 5)]), "big") for x in (a, b))
    assert (next(prints) ^ next(prints)).bit_count() > simhash.NEAR_RADIUS
    read = spark.read.parquet(f"{folder([(1, a), (2, b), (3, prose(200, 5))])}/documents.parquet")
    assert {r.doc_id for r in simhash.near_duplicates(read).collect()} == {1, 3}


@pytest.mark.parametrize("tile", [simhash.NEAR_TILE, 2])
def test_near_duplicates_against_all_pairs(spark, folder, tile):
    r, docs = random.Random(12), [(0, ""), (1, None), (2, "a"), (3, "A"), (4, "a b c d e"), (5, "a b c d e f")]
    for family in range(30):
        base = [f"f{family}w{i}" for i in range(r.choice([5, 6, 8, 9, 10, 14, 24, 60, 150]))]
        line = [f"line{i}" for i in range(12)]
        for _ in range(r.randrange(2, 8)):
            n = round(len(base) * r.choice([0, 0.03, 0.06, 0.1, 0.12, 0.2]))
            text = [f"n{r.getrandbits(40)}" for _ in range(n)] + base[r.choice([0, n]) :] + line * r.randrange(2)
            docs.append((len(docs), " ".join(text)))
    sets = [_set_of(d[1] or "") for d in docs]
    roots = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if _alike(sets[i], sets[j]) and roots[i] != roots[j]:
                old, new = max(roots[i], roots[j]), min(roots[i], roots[j])
                roots = [new if x == old else x for x in roots]
    want = set(roots)
    assert 60 < len(want) < len(docs) - 20
    read = spark.read.parquet(f"{folder(docs)}/documents.parquet")
    assert {r.doc_id for r in simhash.near_duplicates(read, tile=tile).collect()} == want


def test_hashes_looked_up_are_enough_for_any_similar_set():
    r = random.Random(3)
    for _ in range(4000):
        n = r.choice([1, 2, 3, 5, 9, 10, 24, 25, 26, 99, 400])
        a = r.sample(range(3 * n), n)
        b = a[r.randrange(n // 4 + 1) :] + [3 * n + i for i in range(r.randrange(n // 4 + 1))]
        if not b or not _alike(set(a), set(b)):
            continue
        order = {x: r.random() for x in {*a, *b}}
        at = [simhash._lookup(len(s), 0.8) for s in (a, b)]
        first = [sorted(s, key=order.get)[:k] for s, (k, _) in zip((a, b), at)]
        assert len(set(first[0]) & set(first[1])) >= max(enough for _, enough in at) >= 1


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_hashes_found_elsewhere_in_batches_of_any_size(size):
    r = random.Random(size)
    rows = sorted((r.randrange(12), r.randrange(4)) for _ in range(40)) + [(50, 1), (50, 1), (51, 3), (51, 4)]
    batches = [pa.RecordBatch.from_pydict({"hash": [x[0] for x in some], "of": [x[1] for x in some]}) for some in (rows[i : i + size] for i in range(0, len(rows), size))]
    found = {}
    for batch in simhash._found_elsewhere(iter([batches[0].slice(0, 0), *batches])):
        for of, n in zip(batch.column("of").to_pylist(), batch.column("n").to_pylist()):
            found[of] = found.get(of, 0) + n
    want = {}
    for hash_, of in set(rows):
        if any(h == hash_ and o != of for h, o in rows):
            want[of] = want.get(of, 0) + 1
    assert found == want
