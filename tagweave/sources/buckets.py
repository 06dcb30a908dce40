"""A keyed table in Parquet of which an upsert rewrites only the buckets that hold a given key.

Rows lie in folders by a hash of their key. New rows and the kept rows of the touched buckets are written aside first,
then put in place by dynamic partition overwrite. A note names what was written aside until all of it is in place: a
run that died in between is completed by the next write, and readers take those buckets from there meanwhile. Writing
the same rows again leaves the same state. One writer at a time.
"""

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tagweave.session import scratch_path

BUCKETS = 64


class BucketTable:
    """Choose `buckets` so that one holds some hundred megabytes; a table keeps the number it began with.

    A null key is a key like any other. The frames read have the rows' own columns.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.rows = f"{self.path}/rows-of-{buckets}"
        self.note = f"{self.path}/pending"

    def _hadoop(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path, path(self.path).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _pending(self) -> dict | None:
        path, fs = self._hadoop()
        if not fs.exists(path(self.note)):
            return None
        stream = fs.open(path(self.note))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode() or "null")
        finally:
            stream.close()

    def _in_place(self) -> DataFrame | None:
        path, fs = self._hadoop()
        if fs.exists(path(self.path)):
            names = [s.getPath().getName() for s in fs.listStatus(path(self.path))]
            others = [n for n in names if n.startswith("rows-of-") and n != f"rows-of-{self.buckets}"]
            if others:
                raise ValueError(f"{self.path} has {others[0]}, not {self.buckets} buckets")
        if not fs.exists(path(self.rows)) or not any(
                s.getPath().getName().startswith("_bucket=") for s in fs.listStatus(path(self.rows))):
            return None
        return self.spark.read.parquet(self.rows)

    def _whole(self) -> DataFrame | None:
        placed, pending = self._in_place(), self._pending()
        if pending is None:
            return placed
        aside = self.spark.read.parquet(pending["aside"])
        return aside if placed is None else placed.where(~F.col("_bucket").isin(pending["buckets"])).unionByName(aside)

    def exists(self) -> bool:
        return self._whole() is not None

    def read(self) -> DataFrame:
        whole = self._whole()
        if whole is None:
            raise LookupError(f"no rows in {self.path}")
        return whole.drop("_bucket")

    def _buckets_of(self, *frames: DataFrame) -> list[int]:
        """At most `buckets` numbers."""
        return sorted({r["_bucket"] for df in frames for r in df.select("_bucket").distinct().collect()})

    def of(self, keys: DataFrame) -> DataFrame:
        """The rows of the given keys, from their buckets alone."""
        whole = self._whole()
        if whole is None:
            raise LookupError(f"no rows in {self.path}")
        keys = keys.select(F.col(self.key)).withColumn("_bucket", self._bucket())
        own = keys.select(F.col(self.key).alias("_key")).distinct()
        return (whole.where(F.col("_bucket").isin(self._buckets_of(keys)))
                .join(own, F.col(self.key).eqNullSafe(F.col("_key")), "left_semi").drop("_bucket"))

    def upsert(self, rows: DataFrame) -> None:
        """Replace the rows whose key is given and add the new keys; a replaced row is replaced whole."""
        self.replace(rows)

    def replace(self, rows: DataFrame, keys: DataFrame | None = None) -> None:
        """Put these rows, of any number a key, in place of all rows of the given keys (by default their own)."""
        self.complete()
        given = self._written(rows.withColumn("_bucket", self._bucket()), "given")
        gone = given if keys is None else self._written(
            keys.select(F.col(self.key)).withColumn("_bucket", self._bucket()), "gone")
        touched = self._buckets_of(given, gone)
        placed = self._in_place()
        if not touched:
            return
        if placed is not None:
            lost = gone.unionByName(given.select(gone.columns)) if keys is not None else gone
            lost = lost.select(F.col(self.key).alias("_key")).distinct()
            kept = placed.where(F.col("_bucket").isin(touched)).join(
                lost, F.col(self.key).eqNullSafe(F.col("_key")), "left_anti")
            given = kept.unionByName(given)
        aside = scratch_path(self.spark, "bucket-aside")
        given.write.parquet(aside)
        whole = self.spark.read.schema(given.schema).parquet(aside)
        path, fs = self._hadoop()
        stream = fs.create(path(self.note), False)
        try:
            stream.write(bytearray(json.dumps({"aside": aside, "buckets": touched}).encode()))
        finally:
            stream.close()
        self.complete(whole)

    def _written(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, f"bucket-{label}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def complete(self, aside: DataFrame | None = None) -> None:
        """Put in place what a write has left aside; can be repeated. `aside` spares reading its schema."""
        pending = self._pending()
        path, fs = self._hadoop()
        if pending is None:
            # An empty note: its writer died before it could say anything, and nothing has been moved.
            fs.delete(path(self.note), False)
            return
        aside = aside or self.spark.read.parquet(pending["aside"])
        filled = self._buckets_of(aside)
        if filled:
            (aside.repartition(len(filled), "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_bucket").parquet(self.rows))
        for bucket in set(pending["buckets"]) - set(filled):
            fs.delete(path(f"{self.rows}/_bucket={bucket}"), True)
        fs.delete(path(self.note), False)
