import json

import pytest
from pyspark.sql import functions as F

from tagweave.session import scratch_path
from tagweave.streaming.sinks import appended_sink, batch_sinks, read_appended
from tagweave.streaming.sources import from_positions, kafka_offsets, stream_source, unread

SCHEMA = "partition int, offset long, value string"


def rows(spark, counts):
    return spark.createDataFrame([(p, o, f"{p}:{o}") for p, n in counts.items() for o in range(n)], SCHEMA)


def test_offsets_as_the_source_takes_them():
    assert json.loads(kafka_offsets("access", {3: -2, 0: 17})) == {"access": {"0": 17, "3": -2}}


def test_positions_by_partition(spark):
    odd = spark.createDataFrame([(None, 5, "a"), (0, None, "b")], SCHEMA)
    df = rows(spark, {0: 4, 1: 3, 2: 3, 9: 2}).unionByName(odd)
    got = {r["value"] for r in from_positions(df, {0: 2, 1: -2, 2: 99}, others=1).collect()}
    assert got == {"0:2", "0:3", "1:0", "1:1", "1:2", "9:1"}
    assert {r["value"] for r in from_positions(df, {0: 3}, others=None).collect()} == {"0:3"}
    assert from_positions(df, {}).count() == 12
    assert from_positions(df.where("partition > 99"), {0: 1}).count() == 0
    with pytest.raises(ValueError):
        from_positions(df, {0: None})


def test_check_at_the_end(spark):
    table = rows(spark, {0: 4, 1: 3}).where("value <> '0:2'")
    table = table.unionByName(table)
    missing = [tuple(r) for r in unread(table, {0: 1}, {0: 4, 1: 3, 2: 1}).orderBy("partition").collect()]
    assert missing == [(0, 1, 4, 2), (2, 0, 1, 0)]
    assert unread(table, {0: 3, 2: 5}, {0: 4, 2: 5}).count() == 0


def test_a_later_run_goes_on_from_the_checkpoint(spark):
    path = scratch_path(spark, "positions")
    starts = {0: 2, 1: 0}

    def run():
        stream = stream_source(spark, "parquet", f"{path}/records", SCHEMA)
        batch_sinks(from_positions(stream, starts), [appended_sink(f"{path}/table", "first")], f"{path}/checkpoint",
                    "append", {"availableNow": True}).awaitTermination()
        return read_appended(spark, f"{path}/table")

    rows(spark, {0: 4, 1: 3}).write.parquet(f"{path}/records")
    assert unread(run(), starts, {0: 4, 1: 3}).count() == 0
    assert unread(run(), starts, {0: 6, 1: 3}).collect()[0]["present"] == 2
    rows(spark, {0: 6}).where("offset >= 4").write.mode("append").parquet(f"{path}/records")
    table = run()
    assert unread(table, starts, {0: 6, 1: 3}).count() == 0
    assert table.count() == 7 and table.where(F.col("value") == "0:1").count() == 0
