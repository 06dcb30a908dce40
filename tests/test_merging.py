import pytest
from pyspark.sql import functions as F

from tagweave.operators import merging
from tagweave.operators.joins import DEFAULT_BOUND, NEVER_BROADCAST
from tagweave.operators.upsert import upsert
from tagweave.session import scratch_path
from tagweave.sources.store import VersionedTable, upsert_table

PAIR = "userId bigint, tagsId string"


def pairs(df):
    return {r["userId"]: r["tagsId"] for r in df.collect()}


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("bound", [DEFAULT_BOUND, NEVER_BROADCAST])
def test_merge_truth_table(spark, bound, keyed):
    new = spark.createDataFrame([(1, None), (2, "25"), (3, None), (4, "25"), (5, "25"), (6, "25"), (7, "25")], PAIR)
    old = spark.createDataFrame([(1, "8"), (3, None), (4, "24,8,67"), (5, "24,24"), (6, None), (7, "8,25,8"), (9, "1")], PAIR)
    category = spark.createDataFrame([(24,), (25,), (26,)], "id int")
    got = pairs(merging.merge_tags(new, old, category, bound=bound, keyed=keyed))
    assert got == {1: "8", 2: "25", 3: None, 4: "25,67,8", 5: "25", 6: "25", 7: "25,8"}


@pytest.mark.parametrize("bound", [DEFAULT_BOUND, NEVER_BROADCAST])
def test_drop_stale_removes_the_category_without_a_new_tag(spark, bound):
    new = spark.createDataFrame([(1, None), (2, None)], PAIR)
    old = spark.createDataFrame([(1, "24,8"), (2, "24")], PAIR)
    category = spark.createDataFrame([(24,)], "id int")
    assert pairs(merging.merge_tags(new, old, category, drop_stale=True, bound=bound)) == {1: "8", 2: None}


def test_union_merge_keeps_the_category(spark):
    new = spark.createDataFrame([(1, "25"), (2, None)], PAIR)
    old = spark.createDataFrame([(1, "24,8"), (2, "8")], PAIR)
    assert pairs(merging.merge_union(new, old)) == {1: "24,25,8", 2: "8"}
    assert pairs(merging.merge_union(new, old, keyed=True)) == {1: "24,25,8", 2: "8"}


def test_a_keyed_store_needs_no_aggregate(spark):
    new, old = (spark.createDataFrame([(1, "25"), (2, None), (None, "3")], PAIR) for _ in range(2))

    def aggregates(keyed):
        plan = merging.merge_tags(new, old, ["25"], keyed=keyed)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Aggregate [")

    assert (aggregates(True), aggregates(False)) == (1, 2)


def test_collapse_gathers_overlapping_tags(spark):
    new = spark.createDataFrame([(1, "25"), (1, "24"), (1, "25"), (2, None), (3, "9"), (3, None)], PAIR)
    assert pairs(merging.collapse(new)) == {1: "24,25", 2: None, 3: "9"}


def test_upsert_replaces_adds_and_keeps(spark):
    stored = spark.createDataFrame([(1, "24,8"), (2, "25"), (4, None)], PAIR)
    new = spark.createDataFrame([("26", 1), ("24", 3)], "tagsId string, userId bigint")
    once = upsert(stored, new, "userId")
    assert pairs(once) == {1: "26", 2: "25", 3: "24", 4: None}
    assert pairs(upsert(once, new, "userId")) == pairs(once)


def test_upsert_can_replace_by_null(spark):
    stored = spark.createDataFrame([(1, "24")], PAIR)
    assert pairs(upsert(stored, spark.createDataFrame([(1, None)], PAIR), "userId")) == {1: None}


def test_store_versions(spark):
    store = VersionedTable(spark, scratch_path(spark, "store"))
    assert not store.exists()
    with pytest.raises(LookupError):
        store.read()
    new = spark.createDataFrame([(1, "26"), (3, "24")], PAIR)
    assert store.write(spark.createDataFrame([(1, "24,8"), (2, "25")], PAIR)) == 0
    assert store.write(upsert(store.read(), new, "userId")) == 1
    assert pairs(store.read()) == {1: "26", 2: "25", 3: "24"}
    store.write(upsert(store.read(), new, "userId"))
    assert pairs(store.read()) == {1: "26", 2: "25", 3: "24"}
    assert pairs(store.read(0)) == {1: "24,8", 2: "25"}
    store.expire(2)
    assert store.versions() == [1, 2]


def test_failed_write_is_not_seen(spark):
    store = VersionedTable(spark, scratch_path(spark, "store"))
    store.write(spark.createDataFrame([(1, "a")], PAIR))
    broken = spark.range(4).select(F.col("id").alias("userId"), F.raise_error(F.lit("lost")).cast("string").alias("tagsId"))
    with pytest.raises(Exception):
        store.write(broken)
    assert store.versions() == [0] and pairs(store.read()) == {1: "a"}
    assert store.write(spark.createDataFrame([(1, "b")], PAIR)) == 1
    assert pairs(store.read()) == {1: "b"}


def test_plain_table_refuses_row_level_merge(spark):
    """Without a table format for it the merge is refused, so the versioned table is used."""
    name = "plain_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    spark.createDataFrame([(1, "a")], PAIR).write.option("path", scratch_path(spark, "plain")).saveAsTable(name)
    try:
        with pytest.raises(Exception, match="MERGE"):
            upsert_table(spark.createDataFrame([(1, "b")], PAIR), name, "userId")
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_repeated_and_null_users_merge_alike_on_both_sides_of_the_bound(spark):
    new = spark.createDataFrame([(1, "25"), (1, "26"), (None, "25"), (2, None)], PAIR)
    stored = spark.createDataFrame([(1, "8"), (2, "24,9"), (2, "10"), (None, "7")], PAIR)
    category = spark.createDataFrame([("24",), ("25",), ("26",)], "id string")
    for stale in (False, True):
        small, large = (pairs(merging.merge_tags(new, stored, category, stale, bound))
                        for bound in (DEFAULT_BOUND, NEVER_BROADCAST))
        assert small == large == {1: "25,26,8", 2: "10,9" if stale else "10,24,9"}


def test_failed_repeat_and_expiry_leave_readers_alone(spark):
    store = VersionedTable(spark, scratch_path(spark, "store"))
    for n in range(4):
        store.write(spark.range(n + 1))
    held = store.read()
    store.write(spark.range(9))
    store.expire(1)
    assert store.versions() == [4] and held.count() == 4 and store.read().count() == 9
    store.expire(1, grace=-1)
    assert store.read().count() == 9


def test_of_two_writers_of_one_version_one_fails(spark):
    store = VersionedTable(spark, scratch_path(spark, "store"))
    first = VersionedTable(spark, store.path)
    store._markers = lambda: []
    first.write(spark.range(1))
    with pytest.raises(Exception):
        store.write(spark.range(2))
    assert first.read().count() == 1
