from __future__ import annotations

import random
import zlib

import numpy as np

from authorlink.llm import langid
from tests.llm.conftest import rows_of
from tests.llm.texts import documents

_SOUNDS = {"en": ["th", "ing", "ea", "ly", "wh"], "de": ["sch", "ung", "ei", "ü", "pf"], "es": ["ción", "ll", "ñ", "os", "ar"]}


def _corpus(n):
    r = random.Random(5)
    rows = []
    for i in range(n):
        lang = r.choice(list(_SOUNDS))
        rows.append((i, " ".join("".join(r.choices(_SOUNDS[lang], k=3)) for _ in range(30)), lang))
    return rows


def test_counts_of_a_long_text_are_those_of_its_whole(monkeypatch):
    text = "Straße, naïve  東京!! " * 50
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "PART", 37)
    assert (langid.counts(text) == whole).all()


def test_held_out_accuracy_and_no_use_of_labels(spark, folder):
    rows = _corpus(300)
    out = {r[0]: r for r in rows_of(langid.op2_language_id(spark, folder(rows)))}
    held = [(r, out[r[0]]) for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(o[1] for _, o in held) and len(held) > 30
    assert np.mean([r[2] == o[2] for r, o in held]) > 0.95
    # Other labels of held-out documents change nothing.
    turned = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in rows]
    assert sorted(rows_of(langid.op2_language_id(spark, folder(turned)))) == sorted(out.values())


def test_undetermined_and_edge_cases(spark, folder):
    docs = documents()
    out = rows_of(langid.op2_language_id(spark, folder(docs, extra=True)))
    assert len(out) == len(docs)
    by_text = {d[1]: (p, s) for d, (_, _, p, s) in zip(docs, out)}
    for text in (None, "", "   \n\t ", "12 34!? " * 9):
        assert by_text[text] == ("und", 0.0)
    assert all(p in ("en", "fr", "und") and 0 <= s <= 1 for _, _, p, s in out)


def test_nothing_to_learn_from(spark, folder):
    assert rows_of(langid.op2_language_id(spark, folder([(1, "abc", None), (2, "def", None)]))) == [
        (1, False, "und", 0.0),
        (2, zlib.crc32(b"2") % 5 == 0, "und", 0.0),
    ]
    assert langid.op2_language_id(spark, folder([])).count() == 0


def test_temperature_lowers_the_loss_of_sure_errors():
    logits = np.array([[9.0, 0.0], [9.0, 0.0], [0.0, 9.0], [9.0, 0.0]])
    assert langid.calibrated(logits, np.array([0, 0, 1, 1])) > 3
    assert langid.calibrated(np.zeros((0, 2)), np.zeros(0, int)) == 1.0
