import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagweave.operators import clustering, features, scoring
from tagweave.session import scratch_path
from workload import tables


def test_min_max_scaling(spark):
    df = spark.createDataFrame([(0, Vectors.dense([1.0, 0.1, -1.0])), (1, Vectors.dense([2.0, 1.1, 1.0])),
                                (2, Vectors.dense([3.0, 10.1, 3.0]))], ["id", "features"])
    got = {r["id"]: r["scaled"].toArray().tolist() for r in features.min_max_scale(df).collect()}
    assert got[0] == [0, 0, 0] and got[2] == [1, 1, 1] and got[1] == pytest.approx([0.5, 0.1, 0.5])


def test_indexing_and_back(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "a"), (5, "c")], "id int, category string")
    indexed = features.index_strings(df, "category", "at")
    assert {r["id"]: r["at"] for r in indexed.collect()} == {0: 0.0, 1: 2.0, 2: 1.0, 3: 0.0, 5: 1.0}
    restored = features.restore_strings(indexed, "at", "label")
    assert restored.where("label <> category").count() == 0


@pytest.fixture(scope="module")
def vectors(spark, sf_dir):
    return features.to_vectors(tables.load(spark, sf_dir, "embeddings"), "embedding").select("vec_id", "features")


def test_kmeans_assigns_the_nearest_centre_and_repeats(vectors):
    model = clustering.fit_kmeans(vectors)
    centres = np.array(model.clusterCenters())
    rows = clustering.assign(model, vectors).collect()
    for r in rows:
        distance = ((centres - r["features"].toArray()) ** 2).sum(axis=1)
        assert distance[r["prediction"]] == pytest.approx(distance.min())
    again = np.array(clustering.fit_kmeans(vectors).clusterCenters())
    assert centres == pytest.approx(again)


def test_silhouette_against_brute_force(spark):
    points = [(1.0, 1.0), (2.0, 1.0), (4.0, 3.0), (5.0, 4.0)]
    df = spark.createDataFrame([(Vectors.dense(p),) for p in points], ["features"])
    rows = clustering.assign(clustering.fit_kmeans(df), df).collect()
    x = np.array([r["features"].toArray() for r in rows])
    label = np.array([r["prediction"] for r in rows])
    square = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    scores = []
    for i in range(len(x)):
        same = (label == label[i]) & (np.arange(len(x)) != i)
        a, b = square[i, same].mean(), square[i, label != label[i]].mean()
        scores.append((b - a) / max(a, b))
    quality = clustering.quality(df).collect()
    assert sum(r["members"] for r in quality) == 4
    assert all(r["silhouette"] == pytest.approx(np.mean(scores)) for r in quality)


def test_model_is_loaded_once_per_task(spark):
    path = scratch_path(spark, "loads")
    import os
    os.makedirs(path)

    def load():
        import tempfile
        tempfile.mkstemp(dir=path)
        return lambda inputs: inputs * 2

    df = spark.range(1000).repartition(4).select(F.col("id").cast("double").alias("x"))
    scored = df.select("x", scoring.score_with(load, F.col("x"), "double").alias("p"))
    assert scored.where("p <> x * 2").count() == 0
    assert len(os.listdir(path)) == 4


def test_linear_model_gives_floats(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "input double")
    got = [r[0] for r in df.select(scoring.score_with(scoring.linear_model(2.0, 1.0), F.col("input"))).collect()]
    assert got == [3.0, 5.0, 7.0, 9.0]


def test_saved_pipeline(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    path = scratch_path(spark, "model")
    Pipeline(stages=[SQLTransformer(statement="SELECT x, x + 1 AS y FROM __THIS__")]).fit(df).save(path)
    assert [r["y"] for r in scoring.score_pipeline(df, path).orderBy("x").collect()] == [2.0, 3.0]
