"""Clustering of integer vectors, with the nearest centroid found by a threshold algorithm.

The centroids are sorted once per dimension. From a vector's value every dimension's list
is walked outward, nearest centroid first; a centroid met for the first time gets its exact
distance. A centroid not met yet lies beyond the frontier in every dimension, so the sum of
the squared frontier distances bounds its distance from below: a vector is settled when that
sum strictly exceeds its best exact distance. Equal sums walk on, so ties are all compared.

Vectors stay where they are. A round sends one row per centroid and task to the sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import cut_lineage

#: Components of a vector, the scale of integers, centroids, rounds, and what is hashed before an id.
DIMENSIONS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = "3:"
#: Vectors that a task works on at a time.
AT_ONCE = 4096
#: Squared differences of larger components would not add up to a long.
MOST = 1 << 27


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, v) of the vectors with exactly ``dimensions`` components, none NULL or non-finite.

    A component x becomes floor(1024 * x), taken as a double.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    kept = vectors.where((F.size("embedding") == dimensions) & ~bad)
    return kept.select("vec_id", whole.alias("v"))


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS) -> np.ndarray:
    """The vectors whose hashed ids are smallest; ties go by the components, NULL ids last."""
    rank = F.sha2(F.concat(F.lit(SEED), F.col("vec_id").cast("string")), 256)
    found = kept.orderBy(rank.asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([r["v"] for r in found], dtype=np.int64)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid; ties go to the smaller number."""
    n, (clusters, dims) = len(vectors), centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable")
    values = np.full((clusters + 2, dims), 1 << 40, dtype=np.int64)
    values[1:-1] = np.take_along_axis(centroids, order, axis=0)
    values[0] = -(1 << 40)
    lanes = np.arange(dims)
    best = np.full(n, np.iinfo(np.int64).max)
    number = np.zeros(n, dtype=np.int32)
    met = np.zeros((n, clusters), dtype=bool)
    left = sum((values[k] <= vectors).astype(np.int8) for k in range(1, clusters + 1))
    right = left + 1
    going = np.arange(n)
    for _ in range(clusters):
        now = vectors[going]
        below, above = now - values[left, lanes], values[right, lanes] - now
        down = below <= above
        met_now = order[np.where(down, left, right) - 1, lanes]
        fresh = met[going]
        fresh[np.arange(len(going))[:, None], met_now] = True
        fresh &= ~met[going]
        for k in range(clusters):
            rows = np.flatnonzero(fresh[:, k])
            if len(rows):
                away = now[rows] - centroids[k]
                distance = np.einsum("ij,ij->i", away, away)
                places = going[rows]
                better = (distance < best[places]) | ((distance == best[places]) & (k < number[places]))
                best[places[better]], number[places[better]] = distance[better], k
        met[going] |= fresh
        frontier = np.minimum(below, above)
        open_still = np.einsum("ij,ij->i", frontier, frontier) <= best[going]
        left, right = (left - down)[open_still], (right + ~down)[open_still]
        going = going[open_still]
        if not len(going):
            break
    return number, best


def components_of(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    matrix = flat.reshape(len(column), -1)
    if np.abs(matrix).max(initial=0) > MOST:
        raise ValueError(f"components beyond {MOST}: squared distances would not fit a long")
    return matrix


def sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Size and componentwise sum of every non-empty cluster; one row per cluster and task is shuffled."""
    clusters, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, total = np.zeros(clusters, dtype=np.int64), np.zeros((clusters, dims), dtype=np.int64)
        for batch in batches:
            matrix = components_of(batch.column("v"))
            for at in range(0, len(matrix), AT_ONCE):
                part = matrix[at : at + AT_ONCE]
                number, _ = nearest(part, centroids)
                size += np.bincount(number, minlength=clusters)
                for k in np.unique(number):
                    total[k] += part[number == k].sum(axis=0)
        used = np.flatnonzero(size)
        yield pa.RecordBatch.from_pydict({"c": pa.array(used, pa.int32()), "n": size[used], "total": pa.array(list(total[used]), pa.list_(pa.int64()))})

    partial = vectors.select("v").mapInArrow(run, "c int, n long, total array<long>")
    added = partial.groupBy("c").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[d]).alias(f"t{d}") for d in range(dims)])
    return {row["c"]: (row["n"], list(row[2:])) for row in added.collect()}


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = components_of(batch.column("v"))
            parts = [nearest(matrix[at : at + AT_ONCE], centroids) for at in range(0, len(matrix), AT_ONCE)]
            number, distance = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int32), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "cluster": number, "distance": distance})

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def by_cluster(values: dict[int, object], kind: str) -> Column:
    """A value per cluster number, as a literal map."""
    pairs = [part for number, value in values.items() for part in (F.lit(number), F.lit(value).cast(kind))]
    return F.create_map(*pairs)[F.col("cluster")]


def cluster_vectors(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS
) -> DataFrame:
    """Lloyd's rounds in whole numbers over (vec_id, embedding).

    One row per kept vector, repeated rows included: vec_id, cluster, distance (squared),
    cluster_inertia and inertia (distances summed over the cluster and over all), and
    centroid, the final components. Vectors of another length, or with a NULL or non-finite
    component, and NULL vectors are left out. With fewer vectors than ``clusters`` each starts
    a cluster; empty clusters keep their centroid; an empty table gives no rows. A NULL vec_id
    is kept but starts a cluster only after all others. Ties go to the smaller number.
    Components beyond 2**27 raise an error, as their distances are no longs. Other columns
    are ignored. Only centroids and sums, one row per cluster, reach the driver.
    """
    kept = cut_lineage(integer_vectors(vectors, dimensions))
    centroids = first_centroids(kept, clusters)
    if not len(centroids):
        empty = "CAST(NULL AS INT) AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "v AS centroid"
        return kept.selectExpr("vec_id", *empty)
    for _ in range(rounds):
        for number, (n, total) in sums(kept, centroids).items():
            centroids[number] = [t // n for t in total]
    assigned = cut_lineage(assign(kept, centroids))
    inertia = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    final = {number: ",".join(map(str, centroids[number].tolist())) for number in inertia}
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster(inertia, "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.split(by_cluster(final, "string"), ",").cast("array<long>").alias("centroid"),
    )


def sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> str:
    """The same rounds as SQL, one pair of tables per round."""
    square = "CAST(list_sum(list_transform(list_zip(v, cv), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    parts = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
              list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = {dimensions}
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS cv
            FROM (SELECT sha256('{SEED}' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT {clusters}))""",
    ]
    for k in range(rounds + 1):
        parts.append(
            f"a{k} AS MATERIALIZED (SELECT rid, min({{'d': {square}, 'c': c}}) AS best FROM kept, c{k} GROUP BY rid)"
        )
        if k < rounds:
            parts.append(f"""s{k} AS (SELECT best.c AS c, i, sum(v[i]) AS s, count(*) AS n
                FROM a{k} JOIN kept USING (rid), range(1, {dimensions + 1}) AS places(i) GROUP BY ALL)""")
            parts.append(f"""c{k + 1} AS MATERIALIZED (SELECT c, coalesce(nv, cv) AS cv FROM c{k} LEFT JOIN
                (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS nv FROM s{k} GROUP BY c) USING (c))""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(cv, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (rid) JOIN c{rounds} ON c = best.c"""
