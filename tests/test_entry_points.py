"""The two programs to submit, run in-process, and what they rest on."""

import pytest
from pyspark.sql import functions as F

from tagweave.functions import behaviour
from tagweave.plans import run_tags
from tagweave.plans.tag_jobs import NUMBERS, TagJob
from tagweave.session import scratch_path
from tagweave.sources.buckets import BucketTable
from tagweave.sources.store import VersionedTable
from tagweave.streaming import run_stream
from workload import tables


def rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_tag_run(spark):
    path = scratch_path(spark, "run-tags")
    users = [(1, "1"), (2, "2"), (3, "9")]
    spark.createDataFrame(users, "id long, gender string").write.parquet(f"{path}/users")
    source = f"inType=parquet##esNodes={path}##esIndex=users##esType=_doc##selectFields=id,gender"
    tree = [(4, 1, 4, source), (5, 4, 5, "1"), (6, 4, 5, "2")]
    spark.createDataFrame(tree, "id int, pid int, level int, rule string").write.parquet(f"{path}/rules")
    arguments = ["--rules", f"{path}/rules", "--store", f"{path}/store", "--as-of", "2030-01-01", "--jobs", "4"]
    assert [run_tags.main(arguments) for _ in range(2)] == [0, 1]
    assert rows(VersionedTable(spark, f"{path}/store").read()) == [("5", 1), ("6", 2)]


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_stream_run_over_two_runs(spark, mode):
    path = scratch_path(spark, "run-stream")
    arguments = ["behaviour", "--files", f"{path}/in", "--store", f"{path}/store", "--checkpoint", f"{path}/check",
                 "--mode", mode]
    first = [('{"user_id": "a", "user_behavior": {"is_buy": 1}}',), ("no json",),
             ('{"user_id": "b", "user_behavior": {"is_buy": 1}}',)]
    for records in (first, first[:1]):
        spark.createDataFrame(records, "value string").write.mode("append").text(f"{path}/in")
        run_stream.main(arguments).awaitTermination()
    store = BucketTable(spark, f"{path}/store", "user_id") if mode == "update" else VersionedTable(spark, f"{path}/store")
    assert rows(store.read().select("user_id", "is_buy_cnt")) == [(1, "b"), (2, "a")]


def test_stream_arguments_are_checked():
    for wrong in (["behaviour"], ["access", "--files", "x"], ["behaviour", "--topic", "t"]):
        with pytest.raises(SystemExit):
            run_stream.arguments([*wrong, "--store", "s", "--checkpoint", "c"])


def test_rejected_events_are_apart(spark):
    texts = [('{"user_id": "a", "area": {"city": "x"}}',), ("no json",), ('{"user_id": "b"',), (None,), ("",), ("7",)]
    events = spark.createDataFrame(texts, "value string")
    assert [r["user_id"] for r in behaviour.accepted_events(events).collect()] == ["a"]
    assert {r["value"] for r in behaviour.rejected_events(events).collect()} >= {"no json", '{"user_id": "b"', "7"}


def test_a_caller_s_statistic_runs_beside_the_others(spark, sf_dir):
    from tagweave.plans import tag_jobs
    from workload.queries import OPTIONS, SPEND_BAND

    tree, read, stored = tables.rule_tree(spark), tables.source_reader(spark, sf_dir), tables.stored_tags(spark, sf_dir)
    jobs = [*tag_jobs.JOBS.values(), SPEND_BAND]
    whole = tag_jobs.run_jobs(jobs, tree, read, stored, OPTIONS)
    assert rows(whole) == rows(tag_jobs.run_jobs_in_turn(jobs, tree, read, stored, OPTIONS))
    assert whole.where(F.array_contains(F.split("tagsId", ","), "81") | F.col("tagsId").rlike("8[123]")).count() > 0
    with pytest.raises(ValueError):
        TagJob(80, "spend band", "memberid", "amount", match=NUMBERS, statistic="total")
