"""Keyed upserts that rewrite only the buckets of given keys."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tagweave.session import scratch_path
from tagweave.sources.buckets import BucketTable

PAIR = "k bigint, v string"


def rows(df):
    return sorted(((r["k"], r["v"]) for r in df.collect()), key=str)


def files(table):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{table.rows}/**/*.parquet", recursive=True)}


@pytest.fixture()
def table(spark):
    made = BucketTable(spark, scratch_path(spark, "buckets"), "k", 8)
    made.upsert(spark.createDataFrame([(i, f"v{i}") for i in range(100)], PAIR))
    return made


def test_untouched_buckets_keep_their_files(spark, table):
    before = files(table)
    table.upsert(spark.createDataFrame([(7, "new"), (1000, "more")], PAIR))
    after = files(table)
    changed = {os.path.dirname(f) for f in after if before.get(f) != after[f]}
    assert 1 <= len(changed) <= 2 and len(set(before) & set(after)) >= 6
    want = {i: f"v{i}" for i in range(100)} | {7: "new", 1000: "more"}
    assert dict(rows(table.read())) == want and table.read().count() == len(want)
    table.upsert(spark.createDataFrame([(7, "new"), (1000, "more")], PAIR))
    assert dict(rows(table.read())) == want and table.read().count() == len(want)


def test_rows_by_key_are_read_from_their_buckets(spark, table):
    own = table.of(spark.createDataFrame([(3,), (4,), (4,), (999,)], "k bigint"))
    assert rows(own) == [(3, "v3"), (4, "v4")]
    assert "_bucket" in own._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_null_keys_several_rows_a_key_and_removed_keys(spark, table):
    table.replace(spark.createDataFrame([(None, "a"), (None, "b"), (5, "x"), (5, "y")], PAIR))
    assert rows(table.read().where("k IS NULL OR k = 5")) == [(5, "x"), (5, "y"), (None, "a"), (None, "b")]
    table.replace(spark.createDataFrame([(None, "c")], PAIR), spark.createDataFrame([(None,), (5,), (6,)], "k bigint"))
    assert rows(table.read().where("k IS NULL OR k IN (5, 6)")) == [(None, "c")]
    everything = table.read().select("k").distinct()
    table.replace(spark.createDataFrame([], PAIR), everything)
    assert not table.exists()
    with pytest.raises(LookupError):
        table.read()


def test_nothing_given_changes_nothing(spark, table):
    before = files(table)
    table.upsert(spark.createDataFrame([], PAIR))
    assert files(table) == before


@pytest.mark.parametrize("moved", [False, True])
def test_a_write_that_died_is_seen_and_completed(spark, table, monkeypatch, moved):
    """The run ends after its note, before or after the buckets are in place."""
    complete = BucketTable.complete
    calls = []

    def dies(self, aside=None):
        calls.append(1)
        if len(calls) == 2:
            if moved:
                aside.repartition("_bucket").write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.rows)
            raise RuntimeError("lost")
        complete(self, aside)

    monkeypatch.setattr(BucketTable, "complete", dies)
    with pytest.raises(RuntimeError):
        table.upsert(spark.createDataFrame([(7, "new")], PAIR))
    monkeypatch.undo()
    want = {i: f"v{i}" for i in range(100)} | {7: "new"}
    assert dict(rows(table.read())) == want and table.read().count() == 100
    table.upsert(spark.createDataFrame([(8, "next")], PAIR))
    assert dict(rows(table.read())) == want | {8: "next"} and not os.path.exists(table.note)


def test_the_number_of_buckets_stays(spark, table):
    with pytest.raises(ValueError):
        BucketTable(spark, table.path, "k", 9).read()


def test_text_keys_and_skewed_updates(spark):
    table = BucketTable(spark, scratch_path(spark, "buckets"), "name", 4)
    table.upsert(spark.range(1000).select(F.concat(F.lit("n"), "id").alias("name"), F.col("id").alias("n")))
    table.upsert(spark.range(300).select(F.concat(F.lit("n"), "id").alias("name"), (-F.col("id")).alias("n")))
    total = table.read().agg(F.count("*").alias("c"), F.sum("n").alias("s")).first()
    assert (total["c"], total["s"]) == (1000, sum(range(300, 1000)) - sum(range(300)))
