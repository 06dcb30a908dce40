"""Stream sinks. Every query has a checkpoint, so a restart goes on where it stopped."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tagweave.sources.scans import write_jdbc
from tagweave.sources.buckets import BUCKETS, BucketTable
from tagweave.sources.store import VersionedTable

BatchSink = Callable[[DataFrame, int], None]


def _writer(df: DataFrame, checkpoint: str, mode: str, trigger: dict | None):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer


def stream_sink(df: DataFrame, kind: str, checkpoint: str, mode: str = "append",
                trigger: dict | None = None, name: str | None = None, **options) -> StreamingQuery:
    """Start a query into `console`, `memory`, `kafka` or a file format.

    `trigger` is given as Spark takes it: `{'processingTime': '1 minute'}`,
    `{'availableNow': True}` or, for projections only, `{'continuous': '1 second'}`.
    """
    writer = _writer(df, checkpoint, mode, trigger).format(kind).options(**options)
    return writer.queryName(name).start() if name else writer.start()


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, **settings) -> StreamingQuery:
    """Append key and value to a topic."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    return stream_sink(df, "kafka", checkpoint, **{**settings, **options})


def batch_sinks(df: DataFrame, sinks: list[BatchSink], checkpoint: str, mode: str = "complete",
                trigger: dict | None = None) -> StreamingQuery:
    """Start one query that feeds several sinks per micro-batch.

    The source is read and the state kept once; two queries would do both twice.
    A micro-batch may be repeated after a failure, so a sink must give the same
    state when it gets the same batch number again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if len(sinks) > 1:
            batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            if len(sinks) > 1:
                batch.unpersist()

    return _writer(df, checkpoint, mode, trigger).foreachBatch(write).start()


def versioned_sink(path: str, keep: int = 2) -> BatchSink:
    """Each batch result as the next version; see `VersionedTable`.

    A complete result supersedes the one before, so only the newest `keep` stay. The
    newest is the one committed last: batch numbers begin anew with a new checkpoint,
    and a repeated batch commits the same state again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, path)
        table.write(batch)
        table.expire(keep)

    return write


def keyed_sink(path: str, key: str, buckets: int = BUCKETS) -> BatchSink:
    """The changed rows of each batch put in by key, for mode `update`; a repeated batch gives the same state.

    Only buckets that hold a changed key are rewritten; see `BucketTable`.
    """
    return lambda batch, batch_id: BucketTable(batch.sparkSession, path, key, buckets).upsert(batch)


def jdbc_sink(url: str, table: str, properties: dict | None = None) -> BatchSink:
    """Replace a database table by each complete result."""
    return lambda batch, batch_id: write_jdbc(batch, url, table, properties)


def appended_sink(path: str, run: str) -> BatchSink:
    """Each batch's rows once, however often the batch is repeated: a folder of (run, batch number) of its own.

    A repeated batch replaces its folder; one that died half-way has no success mark and is not read
    (`read_appended`). `run` names the query: a new checkpoint counts its batches anew and takes another name.
    """
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}/batch={batch_id:012d}")


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all finished batches, with their run and batch."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    marks = fs.globStatus(hadoop(f"{path.rstrip('/')}/run=*/batch=*/_SUCCESS")) or []
    done = [status.getPath().getParent().toString() for status in marks]
    if not done:
        raise LookupError(f"no finished batch in {path}")
    return spark.read.option("basePath", path).parquet(*done)


def jdbc_once_sink(url: str, table: str, run: str, properties: dict | None = None) -> BatchSink:
    """Append each batch to a database table once, with its run and batch number as columns.

    The rows go in one task, which the database commits as one transaction, so a batch is there whole or not at all;
    a batch whose number is there already is left out. Meant for results, not for bulk loads.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        known = f"(select 1 as known from {table} where run = '{run}' and batch = {batch_id}) ledger"
        if batch.sparkSession.read.jdbc(url, known, properties=properties or {}).isEmpty():
            numbered = batch.withColumn("run", F.lit(run)).withColumn("batch", F.lit(batch_id).cast("long"))
            write_jdbc(numbered.coalesce(1), url, table, properties, mode="append")

    return write


def console_sink(rows: int = 20) -> BatchSink:
    return lambda batch, batch_id: batch.show(rows, truncate=False)


def run_to_table(df: DataFrame, path: str, mode: str = "complete") -> DataFrame:
    """Run a stream over all its present input and give the resulting table."""
    spark: SparkSession = df.sparkSession
    query = batch_sinks(df, [versioned_sink(f"{path}/table")], f"{path}/checkpoint", mode, {"availableNow": True})
    query.awaitTermination()
    return VersionedTable(spark, f"{path}/table").read()
