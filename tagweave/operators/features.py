"""Feature steps on Spark ML."""

from pyspark.ml.feature import IndexToString, MinMaxScaler, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F

from tagweave.operators.joins import DEFAULT_BOUND, Bound, fits, lookup_join
from tagweave.session import written


def to_vectors(df: DataFrame, array: str, features: str = "features") -> DataFrame:
    """Add a dense vector column from an array of numbers."""
    return df.withColumn(features, array_to_vector(F.col(array).cast("array<double>")))


def min_max_scale(df: DataFrame, features: str = "features", output: str = "scaled") -> DataFrame:
    """Scale every dimension to [0, 1] over the whole frame."""
    return MinMaxScaler(inputCol=features, outputCol=output).fit(df).transform(df)


def index_strings(df: DataFrame, column: str, output: str) -> DataFrame:
    """Text to index, the most frequent first, ties in text order."""
    return StringIndexer(inputCol=column, outputCol=output).fit(df).transform(df)


def label_index(df: DataFrame, column: str) -> DataFrame:
    """(label, index) of a column's values, the most frequent first, ties in text order: a written table.

    Labels are ranked where they lie: sorted by ranges over many tasks, numbered within each, and moved by the number of
    labels in the tasks before, which is one row a task. No label goes to the driver. Nulls have no index.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("label")).agg(F.count("*").alias("n"))
    order = [F.desc("n"), F.asc("label")]
    placed = counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = written(placed.select("label", "at"), "labels")
    task, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = (placed.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
             .select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    ranked = placed.withColumn("task", task).join(F.broadcast(tasks), "task")
    return written(ranked.select("label", (F.col("base") + place).cast("double").alias("index")), "label-index")


def index_strings_distributed(df: DataFrame, column: str, output: str, bound: Bound = DEFAULT_BOUND) -> DataFrame:
    """As `index_strings`, for columns of any number of labels; a null keeps a null index."""
    labels = label_index(df, column).select(F.col("label").alias("_label"), F.col("index").alias(output))
    keyed = df.withColumn("_label", F.col(column).cast("string"))
    return lookup_join(keyed, labels, ["_label"], "left", fits(labels, bound), keep=df.columns)


def restore_strings(df: DataFrame, index: str, output: str) -> DataFrame:
    """Index back to text, by the labels the indexer left in the column's metadata."""
    return IndexToString(inputCol=index, outputCol=output).transform(df)
