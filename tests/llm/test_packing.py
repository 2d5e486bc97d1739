from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from authorlink.llm import packing
from tests.llm.conftest import rows_of
from tests.llm.texts import documents


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.default_tokenizer(), memory=50)


_SIGNS = st.text(alphabet="ab é'sñ.,!?\n\t 1²ªº½ß東🎉\x85 \x1c|$<>endoftx", max_size=60)


@settings(max_examples=400, deadline=None)
@given(text=_SIGNS)
def test_ids_are_those_of_the_library(tokenizer, encoder, text):
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want


def test_special_tokens_as_in_the_library(tokenizer, encoder):
    text = "one <|endoftext|> two"
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_fills_bins_within_capacity(sizes):
    bins = packing.best_fit(sizes, 20)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 20 for b in bins)
    assert sum(sum(sizes[i] for i in b) * 2 <= 20 for b in bins) <= 1


def _check(rows, texts, tokenizer, capacity=1024):
    by_sequence: dict[int, list] = {}
    want: dict = {}
    for doc_id, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault(doc_id, []).append(ids)
    pieces: dict = {}
    for doc_id, piece, start, length, crc, sequence, offset in rows:
        assert 0 < length <= capacity
        pieces.setdefault(doc_id, []).append((piece, start, length, crc))
        by_sequence.setdefault(sequence, []).append((offset, length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, versions in want.items():
        expected = []
        for ids in versions:
            cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
            expected += [(p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(pieces.pop(doc_id)) == sorted(expected)
    assert not pieces
    return len(by_sequence), sum(len(i) for v in want.values() for i in v)


def test_query_packs_every_piece_once(spark, folder, tokenizer):
    docs = documents()
    out = packing.op1_best_fit_packing(spark, folder(docs, extra=True))
    n, total = _check(rows_of(out), [d[:2] for d in docs], tokenizer)
    assert n <= -(-total // 1024) + 2


def test_rounds_join_what_the_first_left(spark, folder, tokenizer):
    docs = [(i, "word " * (40 + 7 * i % 400)) for i in range(300)]
    sf = folder(docs)
    pieces = packing.tokenised(spark.read.parquet(f"{sf}/documents.parquet"))
    out = packing.packed(pieces, bucket=40, fan_in=3)
    n, total = _check(rows_of(out), docs, tokenizer)
    assert n <= 1.01 * total / 1024 + 2


def test_items_that_nothing_can_join_end_the_rounds(spark, folder, tokenizer):
    docs = [(i, "word " * 699) for i in range(60)]
    pieces = packing.tokenised(spark.read.parquet(f"{folder(docs)}/documents.parquet"))
    n, _ = _check(rows_of(packing.packed(pieces, bucket=10)), docs, tokenizer)
    assert n == 60


def test_empty_table(spark, folder):
    assert packing.op1_best_fit_packing(spark, folder([])).count() == 0
