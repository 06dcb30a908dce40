"""Versioned folders: a table whose new state appears at once or not at all.

Every write goes to a folder of its own attempt, which no other write ever touches.
A version counts once its marker names that folder; the marker is created only if
there is none of its number, so of two writers one fails and nothing is lost. A job
that dies leaves a folder no marker names. Versions are numbered in order of commit.
"""

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

MARKERS = "_versions"
# Seconds for which the files of an expired version stay for readers that hold it.
GRACE = 3600


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _hadoop(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path
        fs = path(self.path).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return path, fs

    def _marker(self, version: int) -> str:
        return f"{self.path}/{MARKERS}/{version:012d}"

    def _markers(self) -> list[int]:
        path, fs = self._hadoop()
        folder = path(f"{self.path}/{MARKERS}")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def folder(self, version: int) -> str | None:
        """Where a version's rows are; null for a marker whose writer died before naming it."""
        path, fs = self._hadoop()
        stream = fs.open(path(self._marker(version)))
        try:
            name = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return f"{self.path}/{name}" if name else None

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return [n for n in self._markers() if self.folder(n)]

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        if version is None:
            committed = self.versions()
            if not committed:
                raise LookupError(f"no committed version in {self.path}")
            version = committed[-1]
        return self.spark.read.parquet(self.folder(version))

    def write(self, df: DataFrame) -> int:
        """Write a whole state as the next version; fails if another writer commits that number first."""
        known = self._markers()
        version = known[-1] + 1 if known else 0
        name = f"v={version:012d}.{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{self.path}/{name}")
        path, fs = self._hadoop()
        marker = fs.create(path(self._marker(version)), False)
        try:
            marker.write(bytearray(name.encode()))
        finally:
            marker.close()
        return version

    def expire(self, keep: int, grace: float = GRACE) -> None:
        """Forget all but the newest `keep` versions; their files go once they are `grace` seconds old.

        Folders that no marker names may belong to a running write and are left alone,
        unless they are complete, as those of forgotten versions are.
        """
        path, fs = self._hadoop()
        committed = self.versions()
        for version in committed[:-keep]:
            fs.delete(path(self._marker(version)), False)
        kept = {self.folder(n).rsplit("/", 1)[1] for n in committed[-keep:]}
        for status in fs.listStatus(path(self.path)):
            name, old = status.getPath().getName(), time.time() - status.getModificationTime() / 1000 > grace
            number = name[2:14] if name.startswith("v=") else ""
            # A newer one may be about to get its marker.
            if number.isdigit() and int(number) < committed[-1] and name not in kept and old and fs.exists(
                    path(f"{self.path}/{name}/_SUCCESS")):
                fs.delete(status.getPath(), True)


def upsert_table(df: DataFrame, table: str, key: str) -> None:
    """Keyed upsert into a catalog table whose format has row-level updates.

    Such a format rewrites only the files that hold a given key; in plain Parquet
    `buckets.BucketTable` rewrites only the buckets that do.
    """
    merge = df.alias("given").mergeInto(table, F.expr(f"{table}.{key} = given.{key}"))
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def upsert_search_index(df: DataFrame, nodes: str, key: str = "userId", index: str = "tags_result",
                        **options) -> None:
    """Keyed upsert into a search index: the document id is the key column."""
    (df.write.format("es").mode("append")
       .options(**{"es.resource": index, "es.nodes": nodes, "es.mapping.id": key, **options})
       .save())
