from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from authorlink.llm import divergence as dv
from tests.llm.conftest import rows_of
from tests.llm.texts import documents, prose

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _brute(rows, least=3, top=200):
    docs = defaultdict(list)
    for text, lang, source in rows:
        docs[lang or ""].append((source or "", Counter(_TERM.findall(_lower(text or "")))))
    out = []
    for lang, of_lang in docs.items():
        in_documents = Counter(t for _, c in of_lang for t in c)
        kept = [t for t, n in in_documents.items() if n >= least]
        by_source = {s: Counter() for s, _ in of_lang}
        whole = Counter()
        for s, c in of_lang:
            for t in kept:
                by_source[s][t] += c[t]
                whole[t] += c[t]

        def p(counts):
            size = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (size + len(kept)) for t in kept}

        told, q = {s: p(c) for s, c in by_source.items()}, p(whole)
        for s in told:
            pairs = [(o, sum((told[s][t] - told[o][t]) ** 2 // told[o][t] for t in kept)) for o in told if o != s]
            terms = [(t, (told[s][t] - q[t]) ** 2 // q[t]) for t in kept if by_source[s][t] and told[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r + 1) for r, (i, v) in enumerate(found) if part == "pair" or r < top]
    return sorted(out)


def _rows():
    cases = [(t, *([*r, None, None][:2])) for _, t, *r in documents()]
    many = [(prose(40 + 7 * i, 50 + i), "en", f"s{i % 7}") for i in range(30)]
    odd = [("Straße STRASSE straße İI ﬁ", "de", "x"), ("straße\x00ﬁ@a[b`c{d\x7fe", "de", "x"), ("Straße ﬁ a A", "de", "y"), ("ẞ", "de", ""), ("one", "sv", "x"), ("two", "sv", "y")]
    return cases + many + odd


@pytest.mark.parametrize("bits", [64, 7, 3])
def test_query_against_brute_force_with_and_without_collisions(spark, bits):
    rows = _rows()
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(rows_of(dv.divergence(df, bits=bits))) == _brute(rows)


def test_tiles_parts_and_small_tasks(spark, monkeypatch):
    rows = _rows()
    for name, value in (("TILE", 3), ("COUNTS_PER_TASK", 40), ("CELLS", 30), ("TERMS_AT_ONCE", 20)):
        monkeypatch.setattr(dv, name, value)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert sorted(rows_of(dv.divergence(df, top=4))) == _brute(rows, top=4)


def test_query_against_sql(spark, folder):
    sf = folder([(i, *r) for i, r in enumerate(_rows())], extra=True)
    got = rows_of(dv.op11_source_divergence(spark, sf))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    assert sorted(con.execute(dv.OP11_SQL).fetchall()) == sorted(got)


def test_ties_at_the_last_rank_go_by_the_term(spark):
    rows = [(" ".join(f"w{chr(97 + i)}" for i in range(20)), "en", "a")] * 3 + [("other", "en", "b")] * 3
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = sorted(rows_of(dv.divergence(df, top=5)))
    assert got == _brute(rows, top=5)
    assert [r[3] for r in got if r[1:3] == ("a", "term")] == ["wa", "wb", "wc", "wd", "we"]


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = ("Amber " * 40 + "x" * 90 + " stone\n") * 20
    monkeypatch.setattr(dv, "PART", 33)
    parts = list(dv._terms(text.encode()))
    assert len(parts) > 100
    assert Counter(t for part in parts for t in part) == {b"amber": 800, b"x" * 90: 20, b"stone": 20}


def test_counts_beyond_64_bits_of_products(spark):
    # 10**9 times a count of 10**12 has 70 bits.
    df = spark.createDataFrame([(10**12, 3 * 10**12 + 7, 11)], "n long, size long, terms long")
    got = df.select(dv._probability(df.n, df.size, df.terms)).first()[0]
    assert got == 1 + 10**9 * (10**12 + 1) // (3 * 10**12 + 7 + 11)


def test_empty_table_and_languages_without_terms(spark, folder):
    assert rows_of(dv.op11_source_divergence(spark, folder([]))) == []
    rows = [(None, "en", "a"), ("1 2 3", "en", "b"), ("x", "fr", "a")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(rows_of(dv.divergence(df))) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
