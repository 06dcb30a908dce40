"""Kept counts against statistics over the whole history."""

import random

import pytest
from pyspark.sql import functions as F

from tagweave.operators import incremental, statistics
from tagweave.plans.incremental import refresh_tags
from tagweave.plans.tag_jobs import JOBS, RunOptions
from tagweave.session import scratch_path, written
from tagweave.sources.buckets import BucketTable
from workload import tables

SCHEMA = "memberid long, finishtime long, paymentcode string, change string"
DAY = 86_400


def history(rows):
    """The rows left after a feed."""
    left = []
    for *row, kind in rows:
        if incremental.SIGNS[kind] > 0:
            left.append(tuple(row))
        else:
            left.remove(tuple(row))
    return left


def feeds():
    """Batches of random changes, with nulls, ties, entities that vanish, and rows before 1970."""
    rng, live, out = random.Random(5), [], []
    for _ in range(4):
        batch = []
        for _ in range(80):
            row = (rng.choice([1, 2, 3, 4, 5, None]), rng.choice([None, -DAY * 3 - 1, rng.randrange(0, 400 * DAY)]),
                   rng.choice(["alipay", "cod", None]))
            batch.append((*row, "insert"))
            live.append(row)
        for _ in range(30):
            old = live.pop(rng.randrange(len(live)))
            batch.append((*old, rng.choice(["delete", "update_preimage"])))
        batch += [(*row, "delete") for row in live if row[0] == 4]
        live = [row for row in live if row[0] != 4]
        out.append(batch)
    return out


def test_state_follows_inserts_updates_and_deletions(spark):
    state = BucketTable(spark, scratch_path(spark, "state"), "memberid", 4)
    done = []
    for batch in feeds():
        done += batch
        delta = written(incremental.day_counts(spark.createDataFrame(batch, SCHEMA), "memberid", "paymentcode", "finishtime",
                                               incremental.sign_of(F.col("change"))), "delta")
        incremental.apply_changes(state, delta)
        whole = spark.createDataFrame(history(done), SCHEMA.rsplit(",", 1)[0]).where("memberid IS NOT NULL")
        want = statistics.recency_and_favourite(whole, "memberid", "finishtime", "paymentcode", "2001-08-02")
        got = incremental.recency_and_favourite(state.read(), "memberid", "paymentcode", "2001-08-02")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_wrong_changes_raise(spark):
    def counted(rows):
        return incremental.day_counts(spark.createDataFrame(rows, SCHEMA), "memberid", "paymentcode", "finishtime",
                                      incremental.sign_of(F.col("change")))

    with pytest.raises(Exception, match="unknown kind of change: merge"):
        counted([(1, 0, "cod", "merge")]).collect()
    added, gone = counted([(1, 0, "cod", "insert")]), counted([(1, DAY, "cod", "delete")])
    with pytest.raises(Exception, match="more rows taken out"):
        incremental.merged_counts(added, gone).collect()


def test_only_buckets_of_changed_entities_are_read(spark, sf_dir):
    state = BucketTable(spark, scratch_path(spark, "state"), "memberid", 16)
    first, _ = tables.order_changes(spark, sf_dir)
    delta = written(incremental.day_counts(first, "memberid", "paymentcode", "finishtime",
                                           incremental.sign_of(F.col("change"))), "delta")
    incremental.apply_changes(state, delta)
    one = spark.createDataFrame([(delta.first()["memberid"],)], "memberid long")
    plan = state.of(one)._jdf.queryExecution().executedPlan().toString()
    scan = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "_bucket" in scan and "orders" not in plan
    assert {r["memberid"] for r in state.of(one).collect()} == {one.first()["memberid"]}


def test_tags_of_other_entities_keep_their_files(spark, sf_dir):
    jobs, options = [JOBS[23], JOBS[30]], RunOptions(as_of=tables.AS_OF)
    state = BucketTable(spark, scratch_path(spark, "state"), "memberid", 16)
    tags = BucketTable(spark, scratch_path(spark, "tags"), "userId", 16)
    first, _ = tables.order_changes(spark, sf_dir)
    refresh_tags(jobs, tables.rule_tree(spark), state, tags, first, options)
    before = set(tags.read().inputFiles())
    user = first.first()["memberid"]
    refresh_tags(jobs, tables.rule_tree(spark), state, tags, first.where(F.col("memberid") == user).withColumn(
        "change", F.lit("delete")), options)
    assert len(before - set(tags.read().inputFiles())) == 1
    assert tags.of(spark.createDataFrame([(user,)], "userId long")).first()["tagsId"] is None
