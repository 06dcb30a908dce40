"""Nested areas and range matches as arrays, against all ranges one by one."""

import random

import pytest
from pyspark.sql import functions as F

from tagweave.operators import enrichment
from tagweave.operators.joins import DEFAULT_BOUND, NEVER_BROADCAST, range_join, range_matches
from tagweave.operators.matching import attach_ranges
from tagweave.plans import tag_jobs
from workload import tables
from workload.queries import OPTIONS, _overlapping

RANGE = "lo long, hi long, area string"
B = enrichment.BLOCK


def narrowest(ranges, value):
    held = [(hi - lo, -lo, area is not None, area or "", area) for lo, hi, area in ranges
            if lo is not None and hi is not None and lo <= value <= hi]
    return min(held)[-1] if held else "none"


def dimension(seed):
    rng, out = random.Random(seed), [(0, 6 * B - 1, "all"), (B, 3 * B - 1, "two"), (5, 5, None), (9, 4, "reversed"),
                                     (None, 9, "n"), (3 * B - 2, 3 * B + 1, "across"), (0, 6 * B - 1, "all")]
    for i in range(60):
        lo = rng.randrange(0, 5 * B)
        out.append((lo, lo + rng.choice([0, 1, 10, 300, B // 2, B, 2 * B]), f"r{i % 50}"))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pieces_are_disjoint_and_narrowest(spark, seed):
    ranges = dimension(seed)
    pieces = [tuple(r) for r in enrichment.most_specific(spark.createDataFrame(ranges, RANGE)).collect()]
    pieces.sort(key=lambda p: p[0])
    assert all(a[1] < b[0] for a, b in zip(pieces, pieces[1:])) and all(lo <= hi for lo, hi, _ in pieces)
    probes = {x + d for lo, hi, _ in ranges if lo is not None and hi is not None for x in (lo, hi) for d in (-1, 0, 1)}
    probes |= {x for lo, hi, _ in pieces for x in (lo, hi)} | set(range(0, 8 * B, 997))
    for value in probes:
        found = [area for lo, hi, area in pieces if lo <= value <= hi]
        assert (found or ["none"]) == [narrowest(ranges, value)], value


def test_many_ranges_under_one_that_covers_them(spark):
    ranges = (spark.range(100_000).select((F.col("id") * 160).alias("lo"), (F.col("id") * 160 + F.col("id") % 100).alias("hi"),
                                          F.concat(F.lit("r"), "id").alias("area"))
              .unionByName(spark.createDataFrame([(0, (1 << 24) - 1, "cover")], RANGE)))
    pieces = enrichment.most_specific(ranges)
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = pieces.groupBy((F.col("area") == "cover").alias("cover")).agg(F.sum(F.expr("hi - lo + 1")).alias("n")).collect()
    own = sum(i % 100 + 1 for i in range(100_000))
    assert {r["cover"]: r["n"] for r in got} == {False: own, True: (1 << 24) - own}


def test_nested_areas_on_lines(spark):
    areas = spark.createDataFrame([(0, (1 << 32) - 1, "world"), (167772160, 184549375, "ten"), (167772161, 167772161, "one")], RANGE)
    lines = spark.createDataFrame([("10.0.0.1",), ("10.0.0.2",), ("9.9.9.9",), (None,), ("no address",)], "ip string")
    got = {r["ip"]: r["area"] for r in enrichment.add_nested_area(lines, areas).collect()}
    assert got == {"10.0.0.1": "one", "10.0.0.2": "ten", "9.9.9.9": "world", None: "unknown", "no address": "unknown"}


def test_empty_dimension(spark):
    assert not enrichment.most_specific(spark.createDataFrame([], RANGE)).collect()


@pytest.mark.parametrize("bound", [DEFAULT_BOUND, NEVER_BROADCAST])
@pytest.mark.parametrize("crowd", [0, 64])
def test_matches_as_arrays_equal_the_join(spark, bound, crowd, monkeypatch):
    from tagweave.operators import joins

    monkeypatch.setattr(joins, "CROWD", crowd)
    ranges = spark.createDataFrame(dimension(4), RANGE)
    fact = spark.createDataFrame([(i, v) for i, v in enumerate([*range(0, 7 * B, 4001), None, 5, 5])], "id long, v long")
    found = range_matches(fact, "v", ranges, "areas", bound)
    assert found.count() == fact.count() and found.columns == ["id", "v", "areas"]
    arrays = [(r["id"], a["area"]) for r in found.collect() for a in r["areas"]]
    joined = range_join(fact, "v", ranges, "inner", bound)
    assert sorted(arrays, key=str) == sorted(((r["id"], r["area"]) for r in joined.collect()), key=str)


def test_no_ranges_give_empty_arrays(spark):
    fact = spark.createDataFrame([(1, 2)], "id long, v long")
    empty = spark.createDataFrame([], "id long, lo long, hi long")
    assert [tuple(r) for r in attach_ranges(fact, F.col("v"), empty, "tags").collect()] == [(1, 2, [])]


def test_overlapping_jobs_keep_one_row_an_entity(spark, sf_dir):
    """What reaches the last shuffle is one row an order, however many ranges hold its amount."""
    jobs = [_overlapping("spend band", 80), _overlapping("spend steps", 90)]
    orders = tables.order_amounts(spark, sf_dir)
    found = tag_jobs.tagged_rows(orders, jobs, tables.rule_tree(spark), OPTIONS)
    assert found.count() == orders.count()
    assert found.agg(F.max(F.size("found"))).first()[0] >= 3
    stored = tables.stored_tags(spark, sf_dir)
    read = tables.source_reader(spark, sf_dir)
    whole = tag_jobs.run_jobs(jobs, tables.rule_tree(spark), read, stored, OPTIONS)
    turn = tag_jobs.run_jobs_in_turn(jobs, tables.rule_tree(spark), read, stored, OPTIONS)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, turn.collect()), key=str)
