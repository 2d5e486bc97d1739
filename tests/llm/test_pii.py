from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from authorlink.llm import pii
from tests.llm.conftest import rows_of
from tests.llm.texts import documents

_BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _fits(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return True


def _spans(text):
    found = [
        (m.start(), k, m.end(), name)
        for k, (name, pattern) in enumerate(_BASE)
        for m in re.finditer(pattern, text or "")
        if _fits(name, m.group())
    ]
    return [(name, a, b) for a, _, b, name in sorted(found)]


def _check(out, texts):
    for (doc_id, *counts, digest, spans), text in zip(out, texts):
        want = _spans(text)
        assert counts == [sum(k == name for k, _, _ in want) for name, _ in _BASE]
        listed = [f"{k}:{a}:{b}" for k, a, b in want]
        assert digest == hashlib.sha256(",".join(listed).encode()).hexdigest(), text
        assert [s for s in spans.split(",") if s and s.split(":")[0] in dict(_BASE)] == listed


_PARTS = st.sampled_from(
    ["a@b.c", "@", "x.y+z@host-1.org", "%d@e.f", "1.2.3.4", ".5.6", "256.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-111", "30569309025904",
     "+1 (202) 555-0143", "+", "0", "7 ", "-", " ", "é", "🎉", "\n", "(", "tel ", "12345678901234567890", "..", "_"]
)


def test_base_spans_as_by_plain_matching(spark, folder):
    texts: list[str] = []

    @settings(max_examples=250, deadline=None, database=None, derandomize=True)
    @given(st.lists(_PARTS, max_size=14))
    def collect(parts):
        texts.append("".join(parts))

    collect()
    out = rows_of(pii.op10_pii_spans(spark, folder([(i, t) for i, t in enumerate(texts)])))
    _check(sorted(out), texts)


def test_edge_cases_and_very_long_runs(spark, folder):
    docs = [*documents(), (54, "1.2.3.4 " * 3000)]
    # Plain matching would take a time in the square of these.
    long_ = [(50, "a" * 300_000), (51, "1" * 300_000), (52, "1 " * 150_000 + "x"), (53, "+1" + "(" * 200_000)]
    out = rows_of(pii.op10_pii_spans(spark, folder([*docs, *long_], extra=True)))
    _check(out[: len(docs)], [d[1] for d in docs])
    assert [r[-1] for r in out[len(docs) :]] == [""] * 4
    assert pii.op10_pii_spans(spark, folder([])).count() == 0


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("IBAN GB82 WEST 1234 5698 7654 32.", "iban:5:32"),
        ("GB82WEST12345698765432", "iban:0:22"),
        ("GB83WEST12345698765432", ""),
        ("call me at 202-555-0143 today", "local_phone:11:23"),
        ("order 202-555-0143 today", ""),
    ],
)
def test_added_kinds(spark, folder, text, spans):
    assert rows_of(pii.op10_pii_spans(spark, folder([(1, text)])))[0][-1] == spans


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("Phone: 202-555-0143, 202-555-0144", [(7, 19), (21, 33)]),
        ("Phone: 202-555-0143, 202-555-0144, 202-555-0145, 202-555-0146", [(7, 19), (21, 33), (35, 47)]),
        ("202-555-0143, 202-555-0144 tel", [(0, 12), (14, 26)]),
        ("é🎉 202-555-0143, 202-555-0144 mobile", [(3, 15), (17, 29)]),
        ("202-555-0143, 202-555-0144 by my mobile", [(14, 26)]),
        ("202-555-0143, 202-555-0144", []),
    ],
)
def test_words_count_across_neighbouring_matches(spark, folder, text, spans):
    # 48 code points before a match and 24 after it.
    near = [text[max(0, a - 48) : a] + "\n" + text[b : b + 24] for a, b in spans]
    assert all(re.search("phone|tel|mobile", n.lower()) for n in near)
    found = rows_of(pii.op10_pii_spans(spark, folder([(1, text)])))[0][-1]
    assert found == ",".join(f"local_phone:{a}:{b}" for a, b in spans)


def test_context_of_many_short_matches_is_the_text_around_them(spark):
    text = "mail 12 1.2.3.4 " + "12 34,56.78 é9 " * 12 + "+1 5 card 1 2 3\n"
    for kind in pii.KINDS:
        df = spark.createDataFrame([(text,)], "t string")
        row = df.select(F.split("t", kind.pattern, -1).alias("g"), F.regexp_extract_all("t", F.lit(kind.pattern), F.lit(0)).alias("m"))
        spans = row.select(pii._placed(F.col("m"), F.col("g"), kind)).first()[0]
        assert [s.near for s in spans] == [(text[max(0, s.start - 48) : s.start] + "\n" + text[s.end : s.end + 24]).lower() for s in spans]


def test_words_nearby_raise_the_score(spark, folder):
    docs = [(1, "write to a@b.org"), (2, "river a@b.org"), (3, "mailing a@b.org")]
    read = spark.read.parquet(f"{folder(docs)}/documents.parquet")
    scores = {r.doc_id: r.pii[0].score for r in pii.detect(read).collect()}
    assert scores[1] > scores[2] == scores[3]


def test_redaction(spark, folder):
    docs = [(1, "é a@b.org, 1.2.3.4 and +1 202 555 0143!"), (2, "clean"), (3, None), (4, ""), (5, "x@1.2.3.4")]
    read = spark.read.parquet(f"{folder(docs, extra=True)}/documents.parquet")
    out = pii.redacted(read)
    assert out.columns == read.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got[1] == ("é <email>, <ip> and <phone>!", 29 - 1)
    assert got[2] == ("clean", 5) and got[3] == (None, None) and got[4] == ("", 0)
    assert got[5][0] == "<email>"
