"""Batch scans. Each returns a lazy frame of only the columns asked for."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagweave.session import written
from tagweave.sources.spec import SourceSpec


def search_options(spec: SourceSpec) -> dict[str, str]:
    """Options of the search-index connector: field list pushed down, dates kept as text."""
    return {
        "es.resource": spec.index,
        "es.nodes": spec.nodes,
        "es.read.field.include": ",".join(spec.fields),
        "es.mapping.date.rich": "false",
    }


def scan(spark: SparkSession, spec: SourceSpec, **options) -> DataFrame:
    """Read the source a rule names and keep its fields.

    File formats prune columns in the scan. `table` reads the catalog, `jdbc` a
    database named by `url` in the options, `elasticsearch` the search index when
    its connector is on the class path. Any other type is handed to Spark as a
    format name.
    """
    kind = spec.in_type.lower()
    if kind == "table":
        return spark.read.table(spec.index).select(*spec.fields)
    if kind == "jdbc":
        return read_jdbc(spark, table=spec.index, **options).select(*spec.fields)
    if kind in ("es", "elasticsearch"):
        return spark.read.format("es").options(**{**search_options(spec), **options}).load().select(*spec.fields)
    path = f"{spec.nodes.rstrip('/')}/{spec.index}" if spec.nodes else spec.index
    return spark.read.format(kind).options(**options).load(path).select(*spec.fields)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, num_partitions: int = 32) -> DataFrame:
    """A database table; with a numeric `partition_column` it is read in parallel.

    The column's span is asked from the database first, so the split needs no
    bounds from the caller. Filters and columns push down either way. For dates,
    text and skewed numbers see `read_jdbc_by_points`.
    """
    properties = properties or {}
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    span = f"(select min({partition_column}) as lo, max({partition_column}) as hi from {table}) span"
    row = spark.read.jdbc(url, span, properties=properties).first()
    lo, hi = row[0], row[1]
    if lo is None:
        return spark.read.jdbc(url, table, properties=properties)
    if isinstance(lo, (str, bytes, date)):
        raise ValueError(f"{partition_column} is no number: read the table by points")
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=int(lo), upperBound=int(hi) + 1,
                           numPartitions=num_partitions, properties=properties)


def split_points(sample: DataFrame, column: str, num_partitions: int) -> list:
    """At most `num_partitions` - 1 values that cut a column of numbers, dates, times or text into parts of like size.

    The quantiles of the sample's values, each value once: a value that many rows share never cuts twice. Only the
    quantiles come to the driver. Nulls take no part.
    """
    name = F.col(column)
    shares = [i / num_partitions for i in range(1, num_partitions)]
    if not shares:
        return []
    known = sample.where(name.isNotNull()).select(name.alias("v"))
    # Places in sorted order, by counts of distinct values: works for any type that sorts.
    counts = known.groupBy("v").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return []
    ranked = written(counts.repartitionByRange("v").sortWithinPartitions("v").withColumn("task", F.spark_partition_id()),
                     "split-points")
    sums = sorted((r["task"], r["n"]) for r in ranked.groupBy("task").agg(F.sum("n").alias("n")).collect())
    points, before, wanted = [], 0, [s * total for s in shares]
    starts = []
    for task, n in sums:
        starts.append((task, before))
        before += n
    offsets = F.create_map(*[F.lit(x) for pair in starts for x in pair])
    upto = F.sum("n").over(_within_task()) + offsets[F.col("task")]
    placed = ranked.withColumn("_end", upto).withColumn("_start", F.col("_end") - F.col("n"))
    hit = F.lit(False)
    for w in wanted:
        hit = hit | ((F.col("_start") < w) & (F.col("_end") >= w))
    points = sorted(r["v"] for r in placed.where(hit).select("v").collect())
    return points


def _within_task():
    from pyspark.sql import Window

    return Window.partitionBy("task").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)


def _literal(value) -> str:
    """A value as SQL text for the database."""
    if isinstance(value, bool) or value is None:
        raise ValueError(f"no point to split at: {value!r}")
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def split_predicates(column: str, points: list) -> list[str]:
    """Conditions that put each row of a table into exactly one part; rows without a value go with the first."""
    if not points:
        return ["1 = 1"]
    cuts = [_literal(p) for p in points]
    out = [f"{column} < {cuts[0]} OR {column} IS NULL"]
    out += [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [*out, f"{column} >= {cuts[-1]}"]


def read_jdbc_by_points(spark: SparkSession, url: str, table: str, partition_column: str, points: list,
                        properties: dict | None = None) -> DataFrame:
    """A database table read in parallel, one task for each part between the points (`split_points`).

    Numbers, dates, times and text; the database compares text by its own collation, so points of text must have been
    taken from values in that order.
    """
    return spark.read.jdbc(url, table, predicates=split_predicates(partition_column, points), properties=properties or {})


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "overwrite") -> None:
    """Write to a database table; overwrite empties the table and keeps its definition."""
    writer = df.write.option("truncate", "true") if mode == "overwrite" else df.write
    writer.jdbc(url, table, mode=mode, properties=properties or {})


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """Labelled points; the feature count is given at scale, so no extra pass infers it."""
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", num_features)
    return reader.load(path)


def rows(spark: SparkSession, data: list, schema: str) -> DataFrame:
    """A few literal rows under an explicit schema."""
    return spark.createDataFrame(data, schema)
