from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from authorlink.job import SETTINGS
from authorlink.operators import keys
from authorlink.operators.ids import number_densely
from tests.helpers import bag


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a fifth without a key, the rest spread out."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 7).when(i % 5 == 0, None).otherwise(i)
    rows = spark.range(15000).select(key.cast("bigint").alias("k"), F.lit("x").alias("r"), i.alias("v"))
    return rows


@pytest.fixture(scope="module")
def partners(spark):
    return spark.range(0, 4000, 2).select(F.col("id").alias("k"), F.lit("x").alias("r"), (F.col("id") * 10).alias("w")).union(
        spark.createDataFrame([(7, "x", 70), (None, "x", 1)], "k bigint, r string, w bigint")
    )


@pytest.mark.parametrize("on", [["k"], ["k", "r"]])
def test_joins_equal_plain_joins(skewed, partners, on):
    right = partners if len(on) == 2 else partners.drop("r")
    plain = skewed.join(right, on, "left").select("k", "r", "v", "w")
    assert bag(keys.lookup(skewed, right, on), "k", "r", "v", "w") == bag(plain)
    assert bag(keys.match(skewed, right, on), "k", "r", "v", "w") == bag(plain.filter("w IS NOT NULL"))
    gone = skewed.join(right, on, "left_anti").select("k", "r", "v")
    assert bag(keys.exclude(skewed, right, on), "k", "r", "v") == bag(gone)
    met = skewed.join(right, on, "left_semi").select("k", "r", "v")
    assert bag(keys.keep(skewed, right, on), "k", "r", "v") == bag(met)
    flagged = keys.lookup_flag(skewed, right, on, "f")
    assert bag(flagged.filter("f").drop("f"), "k", "r", "v") == bag(met)


@pytest.fixture()
def small_tasks(spark):
    settings = {
        "spark.sql.adaptive.forceOptimizeSkewedJoin": SETTINGS["spark.sql.adaptive.forceOptimizeSkewedJoin"],
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


@pytest.mark.parametrize("key", [7, None])
@pytest.mark.parametrize("how", ["lookup", "exclude", "lookup_flag"])
def test_hot_and_missing_keys_are_split(spark, small_tasks, partners, how, key):
    k = F.when(F.col("id") % 3 == 0, F.lit(key)).otherwise(F.col("id")).cast("bigint")
    rows = spark.range(0, 60_000, 1, 12).select(k.alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    extra = {"lookup": {}, "exclude": {"split": True}, "lookup_flag": {"flag": "f", "split": True}}[how]
    joined = getattr(keys, how)(rows, partners.drop("r"), ["k"], **extra)
    joined = joined.groupBy("v").count()  # a step behind the join doesn't hinder it
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan and "_salt" not in plan


@pytest.mark.parametrize("how", ["exclude", "keep", "lookup_flag"])
@pytest.mark.parametrize("split", [False, True])
def test_a_hot_key_on_the_right_is_combined_before_it_moves(spark, small_tasks, skewed, how, split):
    right = spark.range(0, 60_000, 1, 12).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
    extra = ["f"] if how == "lookup_flag" else []
    joined = getattr(keys, how)(skewed, right, ["k"], *extra, split=split)
    met = skewed.filter("k = 7 OR k % 3 = 0").count()
    assert joined.filter("f" if extra else "true").count() == (15000 - met if how == "exclude" else met)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    right_side = plan[plan.index("SortMergeJoin") :].split("+- Sort")[-1]
    assert "partial" in right_side or "keys=[k" in right_side[right_side.index("Exchange") :]


@pytest.mark.parametrize("on", [["k"], ["k", "r"]])
def test_hashed_joins_equal_sorted_ones_and_sort_nothing(skewed, partners, on):
    right = partners.select(*on).union(partners.select(*on))
    joins = [
        lambda hashed: keys.exclude(skewed, right, on, hashed=hashed),
        lambda hashed: keys.lookup_flag(skewed, right, on, "known", hashed=hashed),
        lambda hashed: keys.update_from(skewed, right.distinct(), on, {"v": F.lit(None)}, hashed),
        lambda hashed: keys.residual_after(skewed, right, on, split=False, hashed=hashed),
    ]
    for join in joins:
        hashed = join(True)
        assert bag(hashed) == bag(join(False))
        plan = hashed._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "Sort [" not in plan


def test_key_types_must_agree(skewed, partners):
    with pytest.raises(TypeError):
        keys.lookup(skewed, partners.withColumn("k", F.col("k").cast("int")), ["k"])


def _not_in(rows, linked):
    """SQL's NOT IN on a key that is NULL as soon as one part is."""
    known = [None if None in key else key for key in linked]
    if not known:
        return sorted(rows, key=str)
    if None in known:
        return []
    return sorted([r for r in rows if None not in r and r not in known], key=str)


def _cases():
    yield [("b", 1), ("b", 2)], [("b", None)]  # a gap on the right: nothing left
    yield [("b", None), ("b", 2)], [("b", 1)]  # a gap on the left: the row is dropped
    yield [("b", None), ("b", 2), ("b", 2)], []  # nothing on the right: everything stays
    rng = random.Random(5)
    for _ in range(4):
        make = lambda n, nulls: [
            (rng.choice("abc"), rng.choice([1, 2, 3, 4] + [None] * nulls)) for _ in range(n)
        ]
        yield make(12, 1), make(4, 0)


@pytest.mark.parametrize(("rows", "linked"), list(_cases()))
def test_residual_is_not_in(spark, rows, linked):
    schema = "a string, b int"
    left, right = spark.createDataFrame(rows, schema), spark.createDataFrame(linked, schema)
    found = sorted([tuple(r) for r in keys.residual_after(left, right, ["a", "b"]).collect()], key=str)
    assert found == _not_in(rows, linked)


def test_residual_null_safe(spark):
    left = spark.createDataFrame([("b", None), ("b", 1), ("b", 2)], "a string, b int")
    right = spark.createDataFrame([("b", None), ("b", 1)], "a string, b int")
    assert bag(keys.residual_after(left, right, ["a", "b"], null_safe=True)) == {("b", 2): 1}


def test_joined_key_parts_are_not_confused(spark):
    left = spark.createDataFrame([("a", "b_c")], "x string, y string")
    right = spark.createDataFrame([("a_b", "c")], "x string, y string")
    assert keys.residual_after(left, right, ["x", "y"]).count() == 1


@pytest.mark.parametrize(
    "rows",
    [
        [("b", 1, "I"), ("b", 2, None), ("b", None, None)],
        [("b", 1, None), ("b", None, None)],
        [("b", None, "I"), ("b", 2, None)],
    ],
)
def test_residual_of_own_links_equals_the_general_one(spark, rows):
    df = spark.createDataFrame(rows, "a string, b int, ref_to string")
    linked = df.filter("ref_to IS NOT NULL")
    general = keys.residual_after(df.filter("ref_to IS NULL"), linked, ["a", "b"])
    assert bag(keys.residual_marked(df, ["a", "b"])) == bag(general)
    marked = keys.mark_taken(df, ["a"], "t")
    by_a = keys.residual_after(df.filter("ref_to IS NULL"), linked, ["a"])
    assert bag(keys.residual_marked(marked, ["a"], taken="t")) == bag(by_a)
    safe = keys.residual_after(df.filter("ref_to IS NULL"), linked, ["a"], null_safe=True)
    assert bag(keys.residual_marked(marked, ["a"], null_safe=True, taken="t")) == bag(safe)


def test_singletons(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", 1), ("a", 1, "y", 1), ("b", 1, "z", 1), ("c", None, "w", 1), ("d", 1, "v", 2)],
        "k string, o int, v string, n int",
    )
    assert set(bag(keys.singletons(df, ["k", "o"]), "k", "v")) == {("b", "z"), ("d", "v")}
    assert set(bag(keys.singletons(df, ["k", "o"], "n"), "k", "v")) == {("b", "z")}


def test_one_per_key_puts_missing_values_last(spark):
    df = spark.createDataFrame([("a", None, 9), ("a", 7, 1), ("a", 5, None), ("b", None, 2)], "k string, o int, v int")
    assert set(bag(keys.one_per_key(df, ["k"], ["o"]), "k", "o", "v")) == {("a", 5, None), ("b", None, 2)}


def test_collapse_copies(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "k string, v int")
    assert bag(keys.collapse_copies(df, "n"), "k", "v", "n") == {("a", None, 2): 1, ("b", 1, 1): 1}


def test_numbers_are_dense_and_in_order(spark, workspace):
    values = spark.range(0, 30000, 3).select(F.format_string("%08d", F.col("id")).alias("v"))
    numbered = number_densely(values.repartition(20), "v", "n", workspace)
    assert "SinglePartition" not in numbered._jdf.queryExecution().toString()
    rows = numbered.orderBy("v").collect()
    assert [r["n"] for r in rows] == list(range(1, 10001))
    assert number_densely(values.limit(0), "v", "n", workspace).count() == 0


def test_residual_plan_has_no_null_aware_broadcast(skewed):
    left = skewed.select("k", "v")
    plan = keys.residual_after(left, left.filter("v < 10"), ["k", "v"])._jdf.queryExecution().toString()
    assert "LeftAnti" in plan
    assert "LeftAnti, BuildRight, true" not in plan
    assert "BroadcastNestedLoopJoin BuildRight, LeftAnti" not in plan
