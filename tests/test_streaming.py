import pytest
from pyspark.sql import functions as F

from tagweave.functions.access_log import parse_lines
from tagweave.session import scratch_path
from tagweave.sources.store import VersionedTable
from tagweave.streaming import jobs, sinks, sources
from workload import tables

AT_ONCE = {"availableNow": True}


def rows(df):
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return tables.load(spark, sf_dir, "events")


def split_in_two(spark, events, render):
    """The rendered records as two text files in a fresh folder; the second is added later."""
    folder = scratch_path(spark, "records")
    records = render(events)
    halves = [records.where(F.hash("value") % 2 == 0), records.where(F.hash("value") % 2 != 0)]

    def add(i):
        halves[i].coalesce(1).write.mode("append").text(folder)

    return folder, add


CASES = {
    "access": (tables.access_lines, lambda df, spark: jobs.access_job(df, tables.area_ranges(spark), tables.AGENT_RULES)),
    "behaviour": (tables.behaviour_records, lambda df, spark: jobs.behaviour_job(df)),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_stream_equals_batch_over_batches_and_a_restart(spark, events, name):
    render, job = CASES[name]
    folder, add = split_in_two(spark, events, render)
    out = scratch_path(spark, "out")

    def run():
        stream = sources.stream_source(spark, "text", folder, "value string", maxFilesPerTrigger=1)
        query = sinks.batch_sinks(job(stream, spark), [sinks.versioned_sink(f"{out}/t")], f"{out}/c", "complete", AT_ONCE)
        query.awaitTermination()

    add(0)
    run()
    table = VersionedTable(spark, f"{out}/t")
    first = rows(table.read())
    add(1)
    run()
    assert rows(table.read()) == rows(job(render(events), spark))
    assert rows(table.read()) != first
    assert len(table.versions()) <= 2
    run()
    assert rows(table.read()) == rows(job(render(events), spark))


def test_table_stream_reads_a_folder_of_files(spark, events):
    """On a cluster a table is a folder; the same name then finds its files."""
    folder = scratch_path(spark, "folder")
    events.repartition(3).write.parquet(f"{folder}/events.parquet")
    out = scratch_path(spark, "out")
    stream = tables.behaviour_records(sources.table_stream(spark, folder, "events", maxFilesPerTrigger=1))
    got = sinks.run_to_table(jobs.behaviour_job(stream), out)
    assert rows(got) == rows(jobs.behaviour_job(tables.behaviour_records(events)))


def test_repeated_batch_leaves_the_same_state(spark):
    path = scratch_path(spark, "sink")
    sink = sinks.versioned_sink(path)
    batch = spark.range(5)
    sink(batch, 0)
    sink(batch, 1)
    sink(batch, 1)
    table = VersionedTable(spark, path)
    assert len(table.versions()) == 2 and table.read().count() == 5


def test_new_checkpoint_supersedes_older_batches(spark):
    """Batch numbers begin anew; the newest result is the one committed last."""
    path = scratch_path(spark, "sink")
    sink = sinks.versioned_sink(path)
    sink(spark.range(4), 10)
    sink(spark.range(4), 11)
    sink(spark.range(99), 0)
    assert VersionedTable(spark, path).read().count() == 99


def test_several_sinks_share_one_query(spark, sf_dir):
    seen = []
    out = scratch_path(spark, "out")
    stream = tables.access_lines(sources.table_stream(spark, sf_dir, "events"))
    query = sinks.batch_sinks(stream, [sinks.versioned_sink(f"{out}/t"), lambda b, i: seen.append((i, b.count())),
                                       sinks.console_sink(1)], f"{out}/c", "append", AT_ONCE)
    query.awaitTermination()
    assert seen == [(0, VersionedTable(spark, f"{out}/t").read().count())]


def test_failed_sink_stops_the_query_and_a_restart_completes(spark, sf_dir):
    out = scratch_path(spark, "out")

    def run(extra):
        stream = tables.behaviour_records(sources.table_stream(spark, sf_dir, "events"))
        query = sinks.batch_sinks(jobs.behaviour_job(stream), [sinks.versioned_sink(f"{out}/t"), *extra],
                                  f"{out}/c", "complete", AT_ONCE)
        query.awaitTermination()

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception):
        run([fail])
    run([])
    batch = jobs.behaviour_job(tables.behaviour_records(tables.load(spark, sf_dir, "events")))
    assert rows(VersionedTable(spark, f"{out}/t").read()) == rows(batch)


def test_memory_and_console_sinks(spark, sf_dir):
    stream = sources.values(tables.access_lines(sources.table_stream(spark, sf_dir, "events")))
    name = "lines_" + scratch_path(spark, "x").rsplit("-", 1)[1]
    sinks.stream_sink(stream, "memory", scratch_path(spark, "c"), "append", AT_ONCE, name=name).awaitTermination()
    assert spark.table(name).count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    sinks.stream_sink(stream, "console", scratch_path(spark, "c"), "append", AT_ONCE, numRows=1).awaitTermination()


def test_late_events_are_dropped_in_append_mode(spark):
    folder, out = scratch_path(spark, "late"), scratch_path(spark, "out")

    def add(*times):
        records = [('{"user_id":"u","visit_time":"%s","user_behavior":{"is_buy":1}}' % t,) for t in times]
        spark.createDataFrame(records, "value string").coalesce(1).write.mode("append").text(folder)
        stream = sources.stream_source(spark, "text", folder, "value string")
        query = sinks.stream_sink(jobs.windowed_behaviour_job(stream), "parquet", f"{out}/c", "append", AT_ONCE,
                                  path=f"{out}/t")
        query.awaitTermination()

    add("2024-01-01 10:00:00", "2024-01-02 12:00:00")
    add("2024-01-01 11:00:00", "2024-01-03 12:00:00")  # the first comes after its window closed
    got = {r["window_start"]: r["is_buy_cnt"] for r in spark.read.parquet(f"{out}/t").collect()}
    assert got == {"2024-01-01 00:00:00": 1, "2024-01-02 00:00:00": 1}


def test_continuous_trigger_for_projections(spark):
    stream = sources.stream_source(spark, "rate", rowsPerSecond=5).selectExpr("cast(value as string) as value")
    name = "continuous_" + scratch_path(spark, "x").rsplit("-", 1)[1]
    query = sinks.stream_sink(stream, "memory", scratch_path(spark, "c"), "append", {"continuous": "1 second"}, name=name)
    try:
        assert query.isActive
        query.awaitTermination(3)
        assert query.exception() is None
    finally:
        query.stop()


def test_processing_time_trigger(spark, sf_dir):
    stream = tables.access_lines(sources.table_stream(spark, sf_dir, "events"))
    out = scratch_path(spark, "out")
    query = sinks.batch_sinks(stream, [sinks.versioned_sink(f"{out}/t")], f"{out}/c", "append", {"processingTime": "1 second"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert VersionedTable(spark, f"{out}/t").read().count() > 0


class Recorder:
    """Stands in for a reader: the Kafka package is not installed here."""

    def __init__(self):
        self.made = {}

    @property
    def readStream(self):
        return self

    def format(self, kind):
        self.made["format"] = kind
        return self

    def options(self, **options):
        self.made.update(options)
        return self

    def load(self):
        return self


def test_kafka_options_pass_through():
    reader = Recorder()
    sources.kafka_source(reader, "host:9092", "topic", '{"topic":{"0":16678}}', maxOffsetsPerTrigger=100)
    assert reader.made == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "topic",
                           "startingOffsets": '{"topic":{"0":16678}}', "maxOffsetsPerTrigger": 100}


class WriteRecorder:
    """Stands in for a stream writer, for the same reason."""

    def __init__(self):
        self.made = []

    @property
    def writeStream(self):
        return self

    def start(self):
        return self.made

    def __getattr__(self, name):
        def record(*args, **options):
            self.made.append((name, args or options))
            return self

        return record


def test_kafka_sink_has_topic_and_checkpoint():
    made = sinks.kafka_sink(WriteRecorder(), "host:9092", "topic", "/shared/ckp", trigger={"processingTime": "1 minute"})
    assert made == [("outputMode", ("append",)), ("option", ("checkpointLocation", "/shared/ckp")),
                    ("trigger", {"processingTime": "1 minute"}), ("format", ("kafka",)),
                    ("options", {"kafka.bootstrap.servers": "host:9092", "topic": "topic"})]


def test_binary_value_becomes_text(spark):
    df = spark.createDataFrame([(bytearray(b"malformed"), 0)], "value binary, partition int")
    assert sources.values(df).first()["value"] == "malformed"
    assert parse_lines(sources.values(df)).count() == 0
