import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.operators import clustering


def brute(points, centres, rounds):
    centres = np.array(centres, dtype=float)
    for _ in range(rounds):
        near = [min(range(len(centres)), key=lambda c: (((p - centres[c]) ** 2).sum(), c)) for p in points]
        for c in set(near):
            centres[c] = np.mean([p for p, n in zip(points, near) if n == c], axis=0)
    return centres


def frame(spark, points):
    return spark.createDataFrame([(i, None if p is None else [None if x is None else float(x) for x in p])
                                  for i, p in enumerate(points)], "id int, v array<double>")


@pytest.mark.parametrize("parts", [1, 7])
def test_lloyd_against_brute_force(spark, parts):
    points = np.random.default_rng(3).normal(size=(300, 5)) + np.arange(300)[:, None] % 4
    start = points[:4].tolist()
    got = clustering.lloyd(frame(spark, points).repartition(parts), start, 6, "v")
    assert np.array(got) == pytest.approx(brute(points, start, 6))


def test_rows_that_are_no_vectors_are_left_out(spark):
    points = [[0, 0], [2, 0], None, [], [1], [float("nan"), 1], [None, 1], [float("inf"), 0], [9, 9], [9, 9], [1, 2, 3]]
    df = frame(spark, points)
    got = clustering.lloyd(df, [[0, 0], [8, 8]], 3, "v")
    assert got == [[1, 0], [9, 9]]
    near = {r["id"]: r["prediction"] for r in clustering.assign_nearest(df, got, "v").collect()}
    assert {i: c for i, c in near.items() if c is not None} == {0: 0, 1: 0, 8: 1, 9: 1}


def test_ties_go_to_the_first_and_a_centre_without_vectors_stays(spark):
    df = frame(spark, [[0, 0], [2, 0]])
    assert clustering.lloyd(df, [[1, 0], [1, 0], [50, 50]], 2, "v") == [[1, 0], [1, 0], [50, 50]]
    assert {r["prediction"] for r in clustering.assign_nearest(df, [[1, 0], [1, 0]], "v").collect()} == {0}


def test_empty_table_and_bad_centres(spark):
    empty = frame(spark, [[0, 0]]).where("id > 0")
    assert clustering.lloyd(empty, [[1, 2]], 3, "v") == [[1, 2]]
    assert clustering.moment_quality(clustering.assign_nearest(empty, [[1, 2]], "v"), "v").count() == 0
    with pytest.raises(ValueError):
        clustering.lloyd(empty, [], 1, "v")


def scores(points, label):
    square = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    out = []
    for i in range(len(points)):
        same = (label == label[i]) & (np.arange(len(points)) != i)
        others = [square[i, label == c].mean() for c in set(label) - {label[i]}]
        a, b = square[i, same].mean() if same.any() else 0, min(others, default=0)
        out.append((b - a) / max(a, b) if same.any() and others and max(a, b) > 0 else 0)
    return np.array(out)


@pytest.mark.parametrize("clusters", [1, 2, 5])
def test_quality_against_brute_force(spark, clusters):
    points = np.random.default_rng(clusters).normal(size=(60, 3)) + 4
    label = np.arange(60) % clusters
    label[0] = 70
    df = frame(spark, points).withColumn("c", F.when(F.col("id") == 0, 70).otherwise(F.col("id") % clusters))
    want = scores(points, label)
    for r in clustering.moment_quality(df.repartition(5), "v", "c").collect():
        assert r["members"] == (label == r["c"]).sum()
        assert r["silhouette"] == pytest.approx(want[label == r["c"]].mean())
        assert r["overall"] == pytest.approx(want.mean())


def test_equal_points_score_zero(spark):
    df = frame(spark, [[1, 1]] * 4).withColumn("c", F.col("id") % 2)
    assert {r["overall"] for r in clustering.moment_quality(df, "v", "c").collect()} == {0.0}
