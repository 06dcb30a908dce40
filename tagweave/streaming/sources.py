"""Stream sources: whatever the kind, a frame with a text column `value`."""

import json

from pyspark.sql import DataFrame, SparkSession, functions as F


def stream_source(spark: SparkSession, kind: str, path: str | None = None, schema=None, **options) -> DataFrame:
    """`kafka` with its own options, a file format with path and schema, or `rate`.

    Kafka options (`kafka.bootstrap.servers`, `subscribe`, `startingOffsets`, ..)
    are passed through. Start offsets count for the first run only; afterwards the
    checkpoint decides.
    """
    reader = spark.readStream.format(kind).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def kafka_source(spark: SparkSession, servers: str, topic: str, offsets: str = "earliest", **options) -> DataFrame:
    """A topic from `earliest`, `latest` or per-partition JSON offsets."""
    return stream_source(spark, "kafka", **{
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": offsets, **options})


def kafka_offsets(topic: str, positions: dict[int, int]) -> str:
    """Positions by partition as the text `kafka_source` takes; -2 is the earliest record, -1 the latest."""
    return json.dumps({topic: {str(p): int(o) for p, o in sorted(positions.items())}})


def from_positions(records: DataFrame, positions: dict[int, int], others: int | None = 0,
                   partition: str = "partition", offset: str = "offset") -> DataFrame:
    """The records at or after a position in their partition, from any source that gives partition and offset.

    Partitions without a position start at `others`; None leaves them out. A negative position, as -2 for the earliest,
    is before every record. Rows without partition or offset have no position and are left out. For sources
    that cannot seek, such as files: what lies before all positions is left out in the scan, and the checkpoint keeps
    later runs from starting over.
    """
    if any(at is None for at in positions.values()):
        raise ValueError("a position must be a number")
    at = F.lit(others).cast("long")
    if positions:
        known = F.create_map(*[F.lit(int(x)).cast("long") for pair in sorted(positions.items()) for x in pair])
        at = F.coalesce(F.try_element_at(known, F.col(partition).cast("long")), at)
    least = min([*positions.values(), *([] if others is None else [others])], default=0)
    return records.where(F.col(partition).isNotNull() & (F.col(offset) >= least) & (F.col(offset) >= at))


def unread(table: DataFrame, starts: dict[int, int], ends: dict[int, int],
           partition: str = "partition", offset: str = "offset") -> DataFrame:
    """(partition, start, end, present) of each partition whose records from start up to end (exclusive) aren't all there.

    A check at the end of a run: an offset counts once, however often it was written. Start defaults to 0.
    """
    spark = table.sparkSession
    wanted = spark.createDataFrame([(p, max(starts.get(p, 0), 0), end) for p, end in sorted(ends.items())],
                                   "p long, start long, end long")
    # Offsets are distinct by partition, so that one busy partition is counted in many tasks.
    there = (table.select(F.col(partition).cast("long").alias("p"), F.col(offset).alias("o")).distinct()
             .join(F.broadcast(wanted), "p").where("o >= start AND o < end").groupBy("p").agg(F.count("*").alias("present")))
    return (wanted.join(there, "p", "left").withColumn("present", F.coalesce("present", F.lit(0)))
            .where("present < end - start").select(F.col("p").alias("partition"), "start", "end", "present"))


def values(records: DataFrame) -> DataFrame:
    """The record value as text."""
    return records.selectExpr("cast(value as string) as value")


def table_stream(spark: SparkSession, folder: str, name: str, **options) -> DataFrame:
    """A stream over the Parquet table `name`, be it one file or a folder of files."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # A one-character class is a glob for exactly this name; a plain file path is refused.
    return stream_source(spark, "parquet", f"{path[:-1]}[{path[-1]}]", schema, **options)
