"""Database reads split at sampled points, sinks that take a batch once, labels ranked without the driver."""

from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from tagweave.operators import features
from tagweave.operators.joins import DEFAULT_BOUND, NEVER_BROADCAST
from tagweave.session import scratch_path
from tagweave.sources import scans
from tagweave.streaming import sinks

VALUES = {
    "bigint": [*range(100), *[7] * 300, None],
    "date": [date(2020, 1, 1 + i % 28) for i in range(100)] + [None],
    "timestamp": [datetime(2020, 1, 1, i % 24, i % 60, 1, 500) for i in range(200)] + [None],
    "string": [*(f"n{i}" for i in range(60)), "it's", "", "é", None, None],
}


@pytest.mark.parametrize("kind", VALUES)
def test_parts_are_disjoint_and_whole(spark, kind):
    df = spark.createDataFrame([(v,) for v in VALUES[kind]], f"v {kind}")
    points = scans.split_points(df, "v", 4)
    assert 1 <= len(points) <= 3 and points == sorted(set(points))
    parts = scans.split_predicates("v", points)
    db = duckdb.connect()
    db.execute(f"CREATE TABLE t (v {'VARCHAR' if kind == 'string' else kind})")
    db.executemany("INSERT INTO t VALUES (?)", [(v,) for v in VALUES[kind]])
    sizes = [db.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in parts]
    assert sum(sizes) == len(VALUES[kind])
    both = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in parts)
    assert db.execute(f"SELECT min({both}), max({both}) FROM t").fetchone() == (1, 1)
    if kind != "bigint":
        assert max(sizes) <= 0.6 * len(VALUES[kind])


def test_points_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "v bigint")
    assert scans.split_points(empty, "v", 4) == [] and scans.split_points(empty, "v", 1) == []
    assert scans.split_predicates("v", []) == ["1 = 1"]


class Recorder:
    def __init__(self, known=()):
        self.calls, self.known = [], known

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return self

    def isEmpty(self):
        return not any(f"batch = {n})" in self.calls[-1][0] for n in self.known)


def test_reads_by_points_are_passed_on():
    reader = Recorder()
    scans.read_jdbc_by_points(reader, "jdbc:x", "t", "born", [date(1990, 1, 1)], {"user": "u"})
    assert reader.calls == [("t", {"predicates": ["born < DATE '1990-01-01' OR born IS NULL", "born >= DATE '1990-01-01'"],
                                   "properties": {"user": "u"}})]


def test_a_span_of_dates_is_refused():
    class Reader(Recorder):
        def first(self):
            return date(2020, 1, 1), date(2021, 1, 1)

    with pytest.raises(ValueError, match="no number"):
        scans.read_jdbc(Reader(), "jdbc:x", "t", partition_column="born")


def test_a_database_batch_is_written_once(spark, monkeypatch):
    wrote = []
    monkeypatch.setattr(sinks, "write_jdbc", lambda df, url, table, properties, mode: wrote.append(
        (df.columns, df.rdd.getNumPartitions(), [tuple(r)[1:] for r in df.collect()], mode)))

    class Batch:
        def __init__(self, known):
            self.sparkSession = Recorder(known)

        def withColumn(self, *args):
            return spark.range(2).repartition(2).withColumn(*args)

    sink = sinks.jdbc_once_sink("jdbc:x", "t", "daily")
    sink(Batch(known=[4]), 5)
    sink(Batch(known=[4, 5]), 5)
    assert wrote == [(["id", "run", "batch"], 1, [("daily", 5)] * 2, "append")]


def test_a_repeated_or_broken_batch_counts_once(spark):
    path = scratch_path(spark, "appended")
    sink = sinks.appended_sink(path, "a")
    with pytest.raises(LookupError):
        sinks.read_appended(spark, path)
    for number, rows in ((0, 3), (0, 3), (1, 2)):
        sink(spark.range(rows), number)
    broken = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception):
        sink(broken, 2)
    assert sinks.read_appended(spark, path).count() == 5
    sink(spark.range(4), 2)
    sinks.appended_sink(path, "b")(spark.range(1), 0)
    assert sinks.read_appended(spark, path).count() == 10


@pytest.mark.parametrize("bound", [DEFAULT_BOUND, NEVER_BROADCAST])
def test_labels_are_ranked_as_by_the_indexer(spark, bound):
    words = [w for i, w in enumerate("delta alpha gamma beta omega".split()) for _ in range(1 + i % 3)] + [None]
    df = spark.createDataFrame(list(enumerate(words)), "id int, word string").repartition(3)
    got = {r["id"]: r["place"] for r in features.index_strings_distributed(df, "word", "place", bound).collect()}
    want = {r["id"]: r["place"] for r in features.index_strings(df.where("word IS NOT NULL"), "word", "place").collect()}
    assert got == want | {len(words) - 1: None}
    assert not features.index_strings_distributed(df.where("id < 0"), "word", "place", bound).collect()
