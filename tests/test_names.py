from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from authorlink.functions import names
from authorlink.operators.delta import cleanse_name_parts, guarded_credits
from authorlink.operators.matching import isni_match_input_full, isni_match_input_incremental, match_input_names
from authorlink import schemas as S
from tests.helpers import bag, credit, table


def _apply(spark, function, rows):
    df = spark.createDataFrame(rows, "i int, a string, b string").orderBy("i")
    return [r[0] for r in df.select("i", function(F.col("a"), F.col("b")).alias("v")).orderBy("i").select("v").collect()]


_PAIRS = [
    (0, "Ann", "Bee"),
    (1, "Ann", None),
    (2, None, "Bee"),
    (3, None, None),
    (4, "Ann", "Ann"),
    (5, "", "Bee"),
    (6, None, ""),
]


@pytest.mark.parametrize(
    ("function", "expected"),
    [
        (names.full_name_guarded, ["Ann Bee", "Ann", "Bee", None, "Ann", "Bee", None]),
        (names.full_name_or_unidentified, ["Ann Bee", "Ann", "Bee", "UNIDENTIFIED", "Ann", " Bee", ""]),
        (names.full_name_strict, ["Ann Bee", None, None, None, "Ann Ann", " Bee", None]),
    ],
)
def test_full_names(spark, function, expected):
    assert _apply(spark, function, _PAIRS) == expected


def test_normalise_name_equals_replacing_everywhere(spark):
    texts = [f"{a}{b} {c}{a}z" for a in ("", " ", "\t", "\u00a0") for b in ("x", "\r\n", "\u00df ") for c in ("", " ", "\n\t")]
    rows = [(i, text, None) for i, text in enumerate(texts)]
    every = lambda n: F.regexp_replace(F.trim(F.upper(F.translate(n, "\r\n\t", "   "))), " +", " ")
    plain = _apply(spark, lambda a, b: names.normalise_name(a), rows)
    assert plain == _apply(spark, lambda a, b: every(a), rows) and len(set(plain)) > 5


def test_normalise_name(spark):
    rows = [(0, "  a\t\nb   c ", None), (1, "\tx\r", None), (2, None, None), (3, "é  É", None)]
    assert _apply(spark, lambda a, b: names.normalise_name(a), rows) == ["A B C", "X", None, "É É"]


def test_placeholder_parts_are_blanked(spark):
    rows = [(0, "UNKNOWN", None), (1, "x (Not Supplied) y", None), (2, "author", None), (3, "Unknown Bee", None), (4, "(not)", None)]
    assert _apply(spark, lambda a, b: names.blank_placeholder(a), rows) == [None, None, None, "Unknown Bee", "(not)"]


def test_cleansed_credits_are_distinct_and_named(spark):
    feed = table(
        spark,
        S.FEED,
        credit(1, "b", "A", 1, "Ann", "unknown"),
        credit(1, "b", "A", 1, "Ann", "Author"),
        credit(2, "b", "A", 2, "Unknown", "Author"),
    )
    cleansed = cleanse_name_parts(feed)
    assert cleansed.count() == 2
    assert bag(guarded_credits(cleansed), "trade_db_contributor_id", "author_nm") == {(1, "Ann"): 1}


def test_matcher_input(spark):
    work = spark.createDataFrame([("Ann",), ("Ann",), ("Unknown",), ("unidentified",), ("ANONYMOUS",)], "author_nm string")
    assert set(bag(match_input_names(work, True))) == {("Ann",), ("ANONYMOUS",)}
    assert match_input_names(work, False).count() == 4
    holders = table(spark, S.ISNI_AUTHORS, {"isni": "1", "first_name": "A"}, {"isni": "2", "first_name": "A", "last_name": "A"})
    assert bag(isni_match_input_incremental(holders), "isni", "author") == {("1", None): 1, ("2", "A A"): 1}
    assert bag(isni_match_input_full(holders), "isni", "author") == {("1", "A"): 1, ("2", "A"): 1}
