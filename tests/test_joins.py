"""Range and lookup joins against brute force, broadcast and shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from tagweave.operators.matching import attach_equal
from tagweave.operators.joins import (DEFAULT_BOUND, NEVER_BROADCAST, Bound, _width_classes, fits, lookup_join,
                                      range_join)

BOUNDS = [DEFAULT_BOUND, NEVER_BROADCAST]


def brute(values, ranges, how):
    out = []
    for key, v in values:
        hits = [name for lo, hi, name in ranges
                if None not in (lo, hi, v) and lo <= v <= hi]
        out += [(key, v, h) for h in hits]
        if not hits and how == "left":
            out.append((key, v, None))
    return sorted(out, key=str)


def case(seed):
    rng = random.Random(seed)
    # A third of all rows hold one value; some ranges are huge, some reversed or null.
    values = [(i, 500 if i % 3 == 0 else rng.randint(-2000, 2000)) for i in range(400)] + [(400, None), (401, None)]
    ranges = []
    for i in range(60):
        lo = rng.randint(-2000, 2000)
        ranges.append((lo, lo + rng.choice([0, 1, 5, 50, 3000]), f"r{i}"))
    return values, ranges + [(10, 5, "reversed"), (None, 7, "open"), (7, None, "open2")]


@pytest.mark.parametrize("bound", BOUNDS)
@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("seed", [1, 2])
def test_range_join_is_exact(spark, bound, how, seed):
    values, ranges = case(seed)
    fact = spark.createDataFrame(values, "key int, v bigint")
    dim = spark.createDataFrame(ranges, "lo bigint, hi bigint, name string")
    got = range_join(fact, "v", dim, how, bound).select("key", "v", "name").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(values, ranges, how)


def test_range_join_without_ranges(spark):
    fact = spark.createDataFrame([(1, 5)], "key int, v bigint")
    none = spark.createDataFrame([], "lo bigint, hi bigint, name string")
    assert [tuple(r) for r in range_join(fact, "v", none, "left").collect()] == [(1, 5, None)]
    assert range_join(fact, "v", none, "inner", small=True).count() == 0


@pytest.mark.parametrize("bound", BOUNDS)
@pytest.mark.parametrize("how", ["inner", "left"])
def test_range_join_of_mixed_widths(spark, bound, how):
    """Many single values, some wide ranges over them and one very wide range."""
    dim = spark.sql("SELECT id * 5 AS lo, id * 5 AS hi, concat('one', id) AS name FROM range(20000) UNION ALL "
                    "SELECT id * 100, id * 100 + 120, concat('some', id) FROM range(200) UNION ALL "
                    "SELECT 90000, 9000000, 'wide'")
    levels = _width_classes(dim, bound)
    assert [(low, high) for low, high, _ in levels] == [(1, 1), (7, 7), (24, 24)]
    values = [(i, v) for i, v in enumerate([0, 5, 7, 100, 110, 95000, 99995, 8999999, -5, None] * 3)]
    ranges = [tuple(r) for r in dim.collect()]
    fact = spark.createDataFrame(values, "key int, v bigint")
    got = range_join(fact, "v", dim, how, bound).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(values, ranges, how)


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_with_hot_and_null_keys(spark, small, how):
    rows = [(i, None if i % 7 == 0 else ("hot" if i % 3 == 0 else f"k{i % 10}")) for i in range(300)]
    fact = spark.createDataFrame(rows + rows, "id int, k string")
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k1", 3), ("zzz", 4)], "k string, v int")
    expected = []
    for i, k in rows + rows:
        hits = [v for key, v in [("hot", 1), ("k1", 2), ("k1", 3)] if key == k]
        expected += [(i, k, v) for v in hits] or ([(i, k, None)] if how == "left" else [])
    got = lookup_join(fact, dim, ["k"], how, small).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted(expected, key=str)


def test_size_check(spark):
    df = spark.createDataFrame([("abc", 1)] * 10, "s string, n int")
    assert fits(df, Bound(rows=10, text_bytes=110))
    assert not fits(df, Bound(rows=9, text_bytes=110))
    assert not fits(df, Bound(rows=10, text_bytes=109))
    assert fits(df.where(F.lit(False)), Bound(rows=0, text_bytes=0))


@pytest.mark.parametrize("data, kind, expected", [
    ([1, 2, None], "bigint", [("1", "10"), ("1", "11"), ("2", None), ("None", None)]),
    ([1.0, 1.5, None], "double", [("1.0", "10"), ("1.0", "11"), ("1.5", "12"), ("None", None)]),
    (["1", "01", "x"], "string", [("01", "11"), ("1", "10"), ("x", "13")]),
])
def test_attribute_type_decides_the_comparison(spark, data, kind, expected):
    rules = spark.createDataFrame([(10, "1"), (11, "01"), (12, "1.5"), (13, "x"), (14, None)], "id int, rule string")
    df = spark.createDataFrame([(v,) for v in data], f"v {kind}")
    for bound in BOUNDS:
        got = attach_equal(df, F.col("v"), rules, "tag", "left", bound).collect()
        assert sorted([(str(r["v"]), r["tag"]) for r in got], key=str) == expected


def test_size_check_sees_every_column(spark):
    df = spark.range(5).selectExpr("id", "array_repeat(id, 10000) AS a", "cast(repeat('x', 1000) AS binary) AS b",
                                   "map(id, 'y') AS m")
    assert not fits(df, Bound(rows=10, text_bytes=50_000)) and fits(df, Bound(rows=10, text_bytes=500_000))


def test_map_columns_and_null_keys_join_either_way(spark):
    fact = spark.sql("SELECT map('a', id) AS m, nullif(id % 4, 0) AS k FROM range(40)")
    lookup = spark.sql("SELECT id AS k, id * 10 AS v FROM range(3)")
    for how in ("inner", "left"):
        small, large = ([(r["m"]["a"], r["k"], r["v"]) for r in lookup_join(fact, lookup, ["k"], how, flag).collect()]
                        for flag in (True, False))
        assert sorted(small, key=str) == sorted(large, key=str) and len(small) == (20 if how == "inner" else 40)
