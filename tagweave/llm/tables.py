"""Inputs of the operators, tables in the shared folder, and gapless numbering in many tasks."""

import contextlib
import math
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagweave.session import scratch_path, written  # noqa: F401

WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, of: int) -> Column:
    """crc32 of the column as text, modulo `of`; of null, that of the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % of


def blocks(rows: int) -> int:
    """Blocks for `running`: as many as a block has rows, so that neither level gathers more than the root of all."""
    return max(1, math.isqrt(rows))


def running(df: DataFrame, by: list[str], block: str, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Adds the sum of `amount` over the earlier rows of the same `by`, in order of `block`, then of `order`.

    Each block is summed in a task of its own and then moved by the total of the blocks before it, so a `by` that
    holds most rows is spread over as many tasks as it has blocks. `by` and `block` must not be null.
    """
    inner = Window.partitionBy(*by, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*by).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    sums = (df.groupBy(*by, block).agg(F.sum(amount).alias("_sum"))
            .select(*by, block, F.coalesce(F.sum("_sum").over(outer), F.lit(0)).alias("_base")))
    return (df.withColumn("_in", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
            .join(sums, [*by, block]).withColumn(name, (F.col("_in") + F.col("_base")).cast("long"))
            .drop("_in", "_base"))


def set_aside(docs: DataFrame, *wanted: str) -> tuple[DataFrame, tuple[str, ...]]:
    """The wanted columns, beside all columns under names that clash with none; and these names, for `keep`."""
    names = docs.columns
    moved = docs.toDF(*(f"in_{i}" for i in range(len(names))))
    return moved.select("*", *(F.col(f"in_{names.index(w)}").alias(w) for w in wanted)), tuple(moved.columns)


def put_back(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, as they were before set_aside."""
    return df.select(*(f"in_{i}" for i in range(len(docs.columns)))).toDF(*docs.columns)


@contextlib.contextmanager
def bucketed(df: DataFrame, label: str, column: str, buckets: int) -> Iterator[DataFrame]:
    """The frame as a table in the shared folder, bucketed by a column: grouping it by that column moves no row again.

    The catalog forgets the table afterwards; its files stay for the folder's retention.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    (df.write.format("parquet").option("path", scratch_path(spark, label)).bucketBy(buckets, column)
     .saveAsTable(name))
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
