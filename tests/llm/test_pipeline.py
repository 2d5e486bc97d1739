from __future__ import annotations

import corpus_pipeline
from authorlink.llm import common, packing
from tests.llm.conftest import CLASHING, rows_of
from tests.llm.texts import documents, prose


def test_stages_keep_columns_and_clean_documents(spark, folder):
    docs = [*documents(), *((1000 + i, prose(80, 700 + i) + f" mail me{i}@host.org", "en", "abc"[i % 3]) for i in range(40))]
    sf = folder(docs, extra=True)
    read = spark.read.parquet(f"{sf}/documents.parquet")
    columns = read.columns
    assert {"row", "size", "_id", "copies"} <= set(columns)
    now = {}
    for name, stage in corpus_pipeline.STAGES:
        read = common.written(stage(spark, read, sf), f"test-{name}")
        now[name] = read
        if name != "packing":
            assert read.columns == columns
            assert {tuple(r) for r in read.select(*CLASHING).collect()} <= {("x",) * len(CLASHING)}
    clean = {1000 + i for i in range(40)}
    kept = {r.doc_id for r in now["language_id"].collect()}
    assert clean <= kept and not {4, 5, 6, 13} & kept
    kept = [r.doc_id for r in now["near_dedup"].collect()]
    assert clean <= set(kept) and len(kept) == len(set(kept)) and not {2, 3} & set(kept)
    texts = {r.doc_id: r.text for r in now["pii"].collect()}
    assert set(texts) == set(kept) and not any("@" in t for t in texts.values())
    assert all("<email>" in texts[i] for i in clean)
    times = [r.doc_id for r in now["mixing"].collect()]
    assert set(times) <= set(kept) and max(times.count(i) for i in kept) <= 2
    encoder = packing.Encoder(packing.default_tokenizer())
    want = sum(len(encoder.encode(texts[i])) // 4 + 1 for i in times)
    assert sum(r.length for r in now["packing"].collect()) == want


def test_run_gives_the_same_sequences_again(spark, folder):
    sf = folder([(i, prose(50 + i, i), "en", "ab"[i % 2]) for i in range(30)])
    first, second = (rows_of(corpus_pipeline.run(spark, sf).drop("sequence_id", "offset")) for _ in range(2))
    assert sorted(first) == sorted(second) and first


def test_empty_table(spark, folder):
    assert corpus_pipeline.run(spark, folder([])).count() == 0
