"""k-means and its quality."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def fit_kmeans(df: DataFrame, k: int = 2, seed: int = 1, features: str = "features") -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features).fit(df)


def assign(model: KMeansModel, df: DataFrame) -> DataFrame:
    """Add `prediction`, the nearest centre of each row."""
    return model.transform(df)


def silhouette(predictions: DataFrame, features: str = "features") -> float:
    """Silhouette with squared Euclidean distance, one pass over cluster sums."""
    return ClusteringEvaluator(featuresCol=features).evaluate(predictions)


def quality(df: DataFrame, k: int = 2, seed: int = 1, features: str = "features") -> DataFrame:
    """One row per cluster: its size, and the silhouette of the whole clustering."""
    predictions = assign(fit_kmeans(df, k, seed, features), df)
    score = silhouette(predictions, features)
    return predictions.groupBy("prediction").agg(F.count(F.lit(1)).alias("members"), F.lit(score).alias("silhouette"))


def _points(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a whole vector of `width` numbers, and those vectors."""
    lists = column.cast(pa.list_(pa.float64()))
    sizes = np.asarray(lists.value_lengths().fill_null(-1))
    flat = np.asarray(lists.filter(pa.array(sizes == width)).flatten().fill_null(np.nan), dtype=float).reshape(-1, width)
    at = np.flatnonzero(sizes == width)
    finite = np.isfinite(flat).all(axis=1)
    return at[finite], flat[finite]


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre of each point, the first of several as near."""
    away = np.stack([np.square(points - c).sum(axis=1) for c in centres], axis=1)
    return away.argmin(axis=1)


def assign_nearest(df: DataFrame, centres: list[list[float]], vector: str) -> DataFrame:
    """Add `prediction`: the nearest of the centres, the first of several as near.

    A vector that is null, of another width, or holds a null, NaN or infinity, gets null.
    """
    own = np.array(centres, dtype=float)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, points = _points(batch.column(vector), own.shape[1])
            found = np.full(batch.num_rows, -1, dtype=np.int32)
            found[at] = _nearest(points, own)
            yield batch.append_column("prediction", pa.array(found, mask=found < 0))

    schema = StructType([*df.schema.fields, StructField("prediction", IntegerType())])
    return df.mapInArrow(near, schema)


def lloyd(df: DataFrame, centres: list[list[float]], rounds: int, vector: str) -> list[list[float]]:
    """The centres after `rounds` steps of Lloyd's from the given ones.

    A step is one pass: each partition adds its vectors up by nearest centre, and Spark adds the partitions' sums, so
    what is shuffled and collected has the size of the centres. A centre without vectors stays. Vectors left out as in
    `assign_nearest`. Given centres and rounds make a result that others can repeat, which a random start does not.
    """
    now = np.array(centres, dtype=float)
    if now.ndim != 2 or not now.size:
        raise ValueError("centres must be vectors of one width, one at least")

    def sums_under(own: np.ndarray):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, totals = np.zeros(len(own), dtype=np.int64), np.zeros(own.shape)
            for batch in batches:
                _, points = _points(batch.column(0), own.shape[1])
                near = _nearest(points, own)
                counts += np.bincount(near, minlength=len(own))
                for c in np.unique(near):
                    totals[c] += points[near == c].sum(axis=0)
            cluster, dim = np.divmod(np.arange(own.size), own.shape[1])
            met = np.repeat(counts, own.shape[1]) > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(cluster[met].astype(np.int32)), pa.array(dim[met].astype(np.int32)),
                 pa.array(np.repeat(counts, own.shape[1])[met]), pa.array(totals.ravel()[met])],
                names=["cluster", "dim", "n", "total"])
        return add

    for _ in range(rounds):
        found = (df.select(vector).mapInArrow(sums_under(now), "cluster int, dim int, n long, total double")
                 .groupBy("cluster", "dim").agg((F.sum("total") / F.sum("n")).alias("mean")).toArrow())
        now = now.copy()
        now[found["cluster"].to_numpy(), found["dim"].to_numpy()] = found["mean"].to_numpy()
    return now.tolist()


def moment_quality(assigned: DataFrame, vector: str, cluster: str = "prediction") -> DataFrame:
    """cluster, members and silhouette (squared distances) of each cluster, and that of all rows as `overall`.

    From sizes, sums and sums of squares of the clusters, which are collected: a row's mean squared distance to a
    cluster needs no more. A row alone in its cluster scores 0, and so does a row where there is one cluster only.
    Rows of a null cluster are left out; vectors must be whole, as `assign_nearest` sees to.
    """
    rows = assigned.where(F.col(cluster).isNotNull()).select(F.col(cluster).alias("_c"), F.col(vector).alias("_v"))
    cells = rows.select("_c", F.posexplode("_v").alias("dim", "x")).withColumn("x", F.col("x").cast("double"))
    sums = cells.groupBy("_c", "dim").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"),
                                          F.count("*").alias("n")).toPandas()
    names = sorted(sums["_c"].unique())
    at = {c: i for i, c in enumerate(names)}
    width = int(sums["dim"].max()) + 1 if len(sums) else 0
    total, square, size = np.zeros((len(names), width)), np.zeros(len(names)), np.zeros(len(names))
    for r in sums.itertuples(index=False):
        total[at[r[0]], r.dim] = r.s
        square[at[r[0]]] += r.q
        size[at[r[0]]] = r.n

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, scores = np.zeros(len(names), dtype=np.int64), np.zeros(len(names))
        for batch in batches:
            _, points = _points(batch.column(1), width)
            own = np.array([at[c] for c in batch.column(0).to_pylist()], dtype=np.int64)
            mean = np.square(points).sum(axis=1)[:, None] + square / size - 2 * points @ (total / size[:, None]).T
            mine = np.arange(len(own)), own
            inside = mean[mine] * size[own] / np.maximum(size[own] - 1, 1)
            mean[mine] = np.inf
            other = mean.min(axis=1, initial=np.inf)
            largest = np.maximum(inside, other)
            good = np.isfinite(other) & (size[own] > 1) & (largest > 0)
            value = np.divide(other - inside, largest, out=np.zeros(len(own)), where=good)
            members += np.bincount(own, minlength=len(names))
            scores += np.bincount(own, weights=value, minlength=len(names))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(names), dtype=np.int32)), pa.array(members),
                                          pa.array(scores)], names=["at", "members", "scores"])

    # One row a cluster and partition; the table of names is as small as the clusters.
    found = rows.mapInArrow(score, "at int, members long, scores double").groupBy("at").agg(
        F.sum("members").alias("members"), F.sum("scores").alias("scores")).orderBy("at").collect()
    everyone = sum(r["members"] for r in found)
    overall = sum(r["scores"] for r in found) / everyone if everyone else None
    kind = assigned.schema[cluster].dataType.simpleString()
    return assigned.sparkSession.createDataFrame(
        [(names[r["at"]].item() if hasattr(names[r["at"]], "item") else names[r["at"]], r["members"],
          float(r["scores"] / r["members"]), float(overall)) for r in found],
        f"`{cluster}` {kind}, members long, silhouette double, overall double")
