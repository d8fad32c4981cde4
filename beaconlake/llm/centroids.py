"""Centroid clustering whose assignments walk sorted centroid lists: Fagin's threshold algorithm, one list per dimension.

Each dimension keeps the centroids sorted by their value there. A vector walks every list outward from its own value: one
centroid a list and step, the nearer of the next one below and the next one above. A centroid that comes up for the first
time gets its exact distance. No centroid that has not come up can be nearer than the sum of the lists' squared frontier
distances, so the walk ends when that sum strictly exceeds the best exact distance (strictly: a tie may still win by its
smaller number), or when all centroids have come up.

All arithmetic is on integers, so the result does not depend on partitions or order. A round reads the vectors once and
returns one row of counts and sums per task and cluster, which Spark adds up; only the centroids themselves, ``k`` rows,
come to the driver, and they travel to the tasks with the function.

Defined cases: a vector with another number of components, a null one or a non-finite one is left out. Fewer vectors than
``k`` give as many centroids as there are vectors, none give no rows. Components are limited to +-2^27 after scaling, so
that a distance fits a long; sums over all vectors are decimals, and limited to the largest long where a column is one.
Repeated rows each count; starting vectors with equal ids follow in the order of their components. A null ``vec_id`` takes
part like any other and comes last among the starting vectors. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import table, written

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
LIMIT = 1 << 27
MAX_LONG = (1 << 63) - 1

#: Vectors compared at a time; bounds a task's memory whatever the size of a batch.
BLOCK = 1024

POINTS = "vec_id long, point array<int>"
ASSIGNED = "vec_id long, cluster int, distance long"


def points(batch: pa.RecordBatch, dimensions: int = DIMENSIONS) -> tuple[pa.Array, np.ndarray]:
    """Ids and scaled integer components of the vectors of a batch that are whole and finite."""
    vectors = batch.column("embedding")
    whole = np.asarray(vectors.value_lengths().fill_null(-1)) == dimensions
    vectors = vectors.filter(pa.array(whole))
    ids = batch.column("vec_id").filter(pa.array(whole))
    flat = vectors.flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    finite = np.isfinite(values).all(axis=1)
    scaled = np.clip(np.floor(SCALE * values[finite]), -LIMIT, LIMIT).astype(np.int32)
    return ids.filter(pa.array(finite)), scaled


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of integer ``vectors``; the smaller number wins a tie."""
    found = np.empty(len(vectors), np.int64), np.empty(len(vectors), np.int64)
    order = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, order, axis=0)
    for start in range(0, len(vectors), BLOCK):
        end = min(start + BLOCK, len(vectors))
        found[0][start:end], found[1][start:end] = _walk(vectors[start:end].astype(np.int64), centroids, order, values)
    return found


def _walk(block: np.ndarray, centroids: np.ndarray, order: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k, dimensions = centroids.shape
    lists = np.arange(dimensions)
    far = np.int64(1) << 30
    # Next centroid above and below the vector's value in every list.
    above = np.stack([np.searchsorted(values[:, d], block[:, d]) for d in lists], axis=1)
    below = above - 1
    distance = np.full((len(block), k), MAX_LONG)
    number, best = np.zeros(len(block), np.int64), np.full(len(block), MAX_LONG)
    walking = np.arange(len(block))
    while len(walking):
        vector, low, high = block[walking], below[walking], above[walking]
        down = np.where(low >= 0, vector - values[np.maximum(low, 0), lists], far)
        up = np.where(high < k, values[np.minimum(high, k - 1), lists] - vector, far)
        go_down = down <= up
        frontier = np.where(go_down, down, up)
        came_up = order[np.where(go_down, low, high), lists]
        below[walking], above[walking] = low - go_down, high + ~go_down

        new = np.zeros((len(walking), k), bool)
        new[np.arange(len(walking))[:, None], came_up] = True
        new &= distance[walking] == MAX_LONG
        row, centroid = np.nonzero(new)
        apart = vector[row] - centroids[centroid]
        distance[walking[row], centroid] = np.einsum("ij,ij->i", apart, apart)

        # The first of equal distances has the smallest number.
        number[walking] = distance[walking].argmin(axis=1)
        best[walking] = distance[walking, number[walking]]
        bound = np.einsum("ij,ij->i", frontier, frontier)
        done = (bound > best[walking]) | (distance[walking] < MAX_LONG).all(axis=1)
        walking = walking[~done]
    return number, best


def scaled_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, point): the whole, finite vectors of ``vectors`` (vec_id, embedding) as integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, scaled = points(batch, dimensions)
            yield pa.RecordBatch.from_arrays([ids, _lists(scaled)], ["vec_id", "point"])

    plain = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
    return plain.mapInArrow(run, POINTS)


def _lists(values: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("point").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def start(kept: DataFrame, k: int = CENTROIDS, seed: int = 2) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of seed and id, in the order of their hashes."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(place.asc_nulls_last(), "point").limit(k).select("point").collect()
    return np.array([row.point for row in rows], np.int64)


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of the mean of each one's vectors; those without vectors stay."""
    k, dimensions = centroids.shape
    names = [f"s{d}" for d in range(dimensions)]
    schema = pa.schema([("cluster", pa.int32()), ("members", pa.int64()), *((name, pa.int64()) for name in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            vectors = _matrix(batch, dimensions)
            number, _ = nearest(vectors, centroids)
            members += np.bincount(number, minlength=k)
            np.add.at(sums, number, vectors.astype(np.int64))
        used = np.flatnonzero(members)
        columns = [used.astype(np.int32), members[used], *sums[used].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], schema=schema)

    ddl = ", ".join(["cluster int", "members long", *(f"{name} long" for name in names)])
    partial = kept.select("point").mapInArrow(run, ddl)
    totals = partial.groupBy("cluster").agg(
        F.sum("members").alias("members"), *[F.sum(F.col(name).cast("decimal(28,0)")).alias(name) for name in names]
    )
    result = centroids.copy()
    for row in totals.collect():
        result[row.cluster] = [int(total) // row.members for total in row[2:]]
    return result


def assigned(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    dimensions = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance = nearest(_matrix(batch, dimensions), centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )

    return kept.mapInArrow(run, ASSIGNED)


def cluster(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 2, dimensions: int = DIMENSIONS
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) per kept vector, final centroids) after ``rounds`` rounds over all vectors."""
    kept = written(scaled_vectors(vectors, dimensions), "centroid-points")
    centroids = start(kept, k, seed)
    if not len(centroids):
        return kept.sparkSession.createDataFrame([], ASSIGNED), centroids
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    return written(assigned(kept, centroids), "centroid-assigned"), centroids


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and distance of every kept vector, the inertia of its cluster and of all, its centroid's digest."""
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    distance = F.sum(F.col("distance").cast("decimal(38,0)"))
    # One row per centroid.
    sums = found.groupBy("cluster").agg(distance.alias("part"))
    total = F.lit(sum(int(row.part) for row in sums.collect())).cast("decimal(38,0)")
    texts = F.array(*[F.lit(",".join(map(str, c))) for c in centroids.tolist()]).cast("array<string>")

    def as_long(column):
        return F.least(column, F.lit(MAX_LONG).cast("decimal(38,0)")).cast("bigint")

    per_cluster = sums.select(
        "cluster", as_long(F.col("part")).alias("cluster_inertia"), as_long(total).alias("inertia"),
        F.sha2(F.get(texts, F.col("cluster")), 256).alias("centroid_sha256"),
    )
    return found.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
