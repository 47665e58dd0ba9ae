"""Clustering by the threshold algorithm against all distances, ties and odd vectors included."""

import brute
import numpy as np
import pytest

from plumbline.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, v int, cluster string"


def rows_of(found):
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
    return sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr)


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in vectors], SCHEMA)


@pytest.mark.parametrize(("clusters", "dims"), [(8, 64), (3, 2), (5, 4)])
def test_nearest_is_the_least_of_all_distances(clusters, dims):
    dice = np.random.default_rng(clusters)
    for spread in (3, 2000):
        vectors = dice.integers(-spread, spread, (700, dims))
        chosen = np.concatenate([vectors[: clusters - 1], vectors[:1]])
        away = ((vectors[:, None, :] - chosen[None]) ** 2).sum(axis=2)
        number, distance = centroids.nearest(vectors, chosen)
        assert (number == away.argmin(axis=1)).all() and (distance == away.min(axis=1)).all()


def test_rounds_with_ties_repeats_and_odd_vectors(spark):
    dice = np.random.default_rng(4)
    vectors = [(i, [float(x) / 8 for x in dice.integers(-3, 4, 4)]) for i in range(60)]
    vectors += vectors[:7] + [(None, [0.5, 0.25, 0.0, -1.0]), (70, None), (71, []), (72, [1.0, 2.0, 3.0])]
    vectors += [(73, [1.0, None, 0.0, 0.0]), (74, [float("nan"), 0.0, 0.0, 0.0]), (75, [0.0, float("-inf"), 0.0, 0.0])]
    for clusters in (3, 200):
        found = centroids.cluster_vectors(table(spark, vectors), clusters=clusters, rounds=4, dimensions=4)
        assert rows_of(found) == sorted(brute.clustering(vectors, clusters, 4, 4), key=repr)


def test_empty_tables_and_far_components(spark):
    empty = table(spark, [])
    found = centroids.cluster_vectors(empty, dimensions=4)
    assert found.count() == 0 and found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    with pytest.raises(Exception, match="would not fit a long"):
        centroids.cluster_vectors(table(spark, [(1, [3e30, 0.0])]), dimensions=2).count()
