"""Statistical attributes of an entity, and the small relational steps around them."""

from pyspark.sql import Column, DataFrame, Window, functions as F


def days_since(seconds: Column, as_of: Column) -> Column:
    """Whole days from the UTC day of an epoch second to `as_of`, in any session zone."""
    second = seconds.cast("bigint")
    day = (second - F.pmod(second, F.lit(86_400))) / 86_400
    return F.datediff(as_of, F.date_from_unix_date(day.cast("int")))


def recency_days(df: DataFrame, key: str, seconds: str, as_of: str) -> DataFrame:
    """(key, days): days from the latest event of each key to the date `as_of`."""
    latest = df.groupBy(key).agg(F.max(seconds).alias("_latest"))
    return latest.select(key, days_since(F.col("_latest"), F.to_date(F.lit(as_of))).alias("days"))


def category_counts(df: DataFrame, key: str, category: str) -> DataFrame:
    """(key, category, count). Rows with a null key count zero, as `count(key)` does."""
    return df.groupBy(key, category).agg(F.count(key).alias(f"{category}_cnt"))


def rank_categories(df: DataFrame, key: str, category: str) -> DataFrame:
    """Categories of each key numbered by falling count, ties by category.

    Counting combines on the map side before the first shuffle. A filter on `rn`
    becomes a per-task group limit before the second, so a key with a great many
    categories does not gather in one task.
    """
    order = Window.partitionBy(key).orderBy(F.desc(f"{category}_cnt"), F.asc(category))
    return category_counts(df, key, category).withColumn("rn", F.row_number().over(order))


def nth_most_frequent(df: DataFrame, key: str, category: str, n: int = 1) -> DataFrame:
    """(key, category) holding rank `n`; keys with fewer categories are absent."""
    return rank_categories(df, key, category).where(F.col("rn") == n).select(key, category)


def recency_and_favourite(df: DataFrame, key: str, seconds: str, category: str, as_of: str) -> DataFrame:
    """(key, days, category): both statistics from one scan.

    The per-category counts carry the latest event along; the second step is an
    aggregate with map-side combine, so no window and no further scan are needed.
    """
    counts = df.groupBy(key, category).agg(
        F.count(key).alias("_count"), F.max(seconds).alias("_latest"))
    best = F.min(F.struct((-F.col("_count")).alias("order"), F.col(category).alias("name")))
    both = counts.groupBy(key).agg(F.max("_latest").alias("_latest"), best.alias("_best"))
    days = days_since(F.col("_latest"), F.to_date(F.lit(as_of)))
    return both.select(key, days.alias("days"), F.col("_best.name").alias(category))


def keyed_reduce(df: DataFrame, key: str, value: str, zero: int = 0) -> DataFrame:
    """Per key: the sum, the largest value starting from `zero`, and (sum, count)."""
    total = F.sum(value)
    return df.groupBy(key).agg(
        total.alias("reduced"),
        F.greatest(F.max(value), F.lit(zero)).alias("folded"),
        F.struct(total.alias("sum"), F.count(value).alias("count")).alias("aggregated"),
    )


def preview(df: DataFrame, order: list, n: int = 20) -> DataFrame:
    """The first `n` rows in a given order: a top-k, no global sort."""
    return df.orderBy(*order).limit(n)


def changed_since(df: DataFrame, since: str, created: str = "created_at", updated: str = "updated_at") -> DataFrame:
    """Rows created or updated at or after `since`, for incremental tagging."""
    start = F.lit(since).cast("timestamp_ntz")
    return df.where((F.col(created) >= start) | (F.col(updated) >= start))


def map_to_entity(fact: DataFrame, mapping: DataFrame, fact_key: str, mapping_key: str, entity: str) -> DataFrame:
    """Business rows with the entity id that owns them; rows without an owner drop.

    A plain equi-join: Catalyst broadcasts the mapping where its measured size
    allows, else both sides shuffle and a hot key is split by the adaptive skew join.
    """
    owner = mapping.select(F.col(mapping_key).alias("_owner_key"), F.col(entity).alias("userId"))
    joined = fact.join(owner, F.col(fact_key) == F.col("_owner_key"))
    return joined.select("userId", *fact.columns)
