"""Recency and favourites kept up to date from changed rows alone.

The kept state counts rows by entity, category and day. Adding a row counts one more, and a row that was deleted, or the
old image of an updated one, counts one less. So the latest day and the most frequent category of an entity follow from
its state even if the row that gave the latest day is gone, and history need not be read again.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tagweave.operators.statistics import days_since
from tagweave.sources.buckets import BucketTable

# Kinds of change as change feeds name them, and what each adds to a count.
SIGNS = {"insert": 1, "update_postimage": 1, "delete": -1, "update_preimage": -1}


def sign_of(kind: Column) -> Column:
    """What a change adds to the counts; an unknown kind raises."""
    sign = F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce(kind, F.lit("null")))).cast("int")
    for name, value in SIGNS.items():
        sign = F.when(kind == name, value).otherwise(sign)
    return sign


def day_counts(rows: DataFrame, key: str, category: str, seconds: str, sign: Column | None = None) -> DataFrame:
    """(key, category, day, n): rows by entity, category and UTC day; rows without an entity count nowhere."""
    second = F.col(seconds).cast("bigint")
    day = F.floor(second / 86_400).cast("int")
    counted = F.sum(F.lit(1) if sign is None else sign).cast("bigint")
    return rows.where(F.col(key).isNotNull()).groupBy(key, category, day.alias("day")).agg(counted.alias("n"))


def merged_counts(kept: DataFrame, delta: DataFrame) -> DataFrame:
    """Kept counts and those of changes as one. A count below zero raises: a row was taken out that never came in."""
    both = kept.unionByName(delta).groupBy(*[c for c in kept.columns if c != "n"]).agg(F.sum("n").alias("n"))
    checked = F.when(F.col("n") >= 0, F.col("n")).otherwise(F.raise_error(F.lit("more rows taken out than came in")).cast("bigint"))
    return both.withColumn("n", checked).where("n > 0")


def recency_and_favourite(counts: DataFrame, key: str, category: str, as_of: str) -> DataFrame:
    """(key, days, category) from day counts: what `statistics.recency_and_favourite` gives from the rows."""
    per_category = counts.groupBy(key, category).agg(F.sum("n").alias("_count"), F.max("day").alias("_latest"))
    best = F.min(F.struct((-F.col("_count")).alias("order"), F.col(category).alias("name")))
    both = per_category.groupBy(key).agg(F.max("_latest").alias("_latest"), best.alias("_best"))
    days = days_since(F.col("_latest").cast("bigint") * 86_400, F.to_date(F.lit(as_of)))
    return both.select(key, days.alias("days"), F.col("_best.name").alias(category))


def apply_changes(state: BucketTable, delta: DataFrame) -> DataFrame:
    """Merge the counts of changes (a written table) into the state; the new counts of the entities that changed.

    Reads the changes and the buckets of their entities, nothing else. Applying the same changes twice counts them
    twice: the caller keeps track of what it has applied.
    """
    keys = delta.select(state.key).distinct()
    counts = merged_counts(state.of(keys), delta) if state.exists() else merged_counts(delta.where(F.lit(False)), delta)
    state.replace(counts, keys)
    return state.of(keys) if state.exists() else delta.where(F.lit(False))
