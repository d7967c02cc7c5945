"""Operator 13: centroids of integer vectors, with distances gathered from scalar lookup tables.

Components are whole numbers, and few different ones occur in a batch. In every round a task tabulates
the squared difference between each occurring value and each centroid's component, dimension by
dimension; a vector's distances to all centroids are sums of table entries, and nothing is multiplied
per vector. Values that occur are marked in a bitmap where they lie close together, sorted otherwise.

Each task adds up its vectors' components per cluster; only these sums, clusters x dimensions rows of a
task, are shuffled, and only the centroids come to the driver. So it does not matter how many vectors
fall into one cluster. A round that changes no centroid ends the walk, because all later rounds would
repeat it.

Defined cases: vectors that are null, of another length, or hold a null or non-finite component take no
part; a null vec_id counts as the empty text where the first centroids are chosen; rows that repeat are
as many vectors, and ties in the first choice go to the smaller vector; with fewer vectors than centroids
there are as many centroids as vectors; an empty table gives no rows; components beyond 64 bits are the
nearest 64-bit number, sums and distances are exact, and a distance beyond 64 bits becomes the largest
number; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fovea.llm.common import materialize, prepare

CLUSTERS, ROUNDS, WIDTH, SCALE, SEED = 8, 10, 64, 1024, 3
#: Values gathered at a time.
SLICE_VALUES = 1 << 18
#: Widest range of values that is marked in a bitmap.
BITMAP = 1 << 20
LARGEST = (1 << 63) - 1


def integer_vectors(
    rows: DataFrame, width: int = WIDTH, scale: int = SCALE, vector: str = "embedding"
) -> DataFrame:
    """(vec_id, v): components floor(scale * x) of the vectors that take part."""
    wide = F.col(vector).cast("array<double>")
    sound = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.where(wide.isNotNull() & (F.size(wide) == width)).where(sound)
    whole = lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(2.0**62)), F.lit(-(2.0**62))))
    return kept.select("vec_id", F.transform(wide, lambda x: whole(x).cast("bigint")).alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors whose ids hash to the smallest values, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    found = vectors.orderBy(F.sha2(name, 256), "v").limit(clusters)
    return [list(row["v"]) for row in found.select("v").collect()]


class Tables:
    """Squared differences of a batch's values to the centroids' components."""

    def __init__(self, x: np.ndarray, centroids: np.ndarray):
        """`x` is (vectors, dimensions), `centroids` (clusters, dimensions), whole numbers."""
        low, high = int(x.min()), int(x.max())
        if high - low < BITMAP:
            seen = np.zeros(high - low + 1, bool)
            seen[(x - low).ravel()] = True
            values = np.nonzero(seen)[0] + low
            codes = (np.cumsum(seen) - 1)[x - low]
        else:
            values, codes = np.unique(x, return_inverse=True)
            codes = codes.reshape(x.shape)
        reach = max(abs(low), abs(high), int(abs(centroids.astype(object)).max()))
        # exact in 64 bits, or in whole numbers of any size
        kind = np.int64 if 4 * reach * reach * x.shape[1] < 1 << 62 else object
        difference = values.astype(kind)[None, :, None] - centroids.T.astype(kind)[:, None, :]
        # an entry for each dimension and value, holding its difference to every centroid
        self.entries = (difference * difference).reshape(-1, len(centroids))
        self.codes = codes + np.arange(x.shape[1]) * len(values)

    def distances(self) -> np.ndarray:
        """(vectors, clusters)"""
        return self.entries[self.codes].sum(1)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector, the smaller number on ties."""
    distances = Tables(x, centroids).distances()
    cluster = distances.argmin(1).astype(np.int64)
    best = distances[np.arange(len(x)), cluster]
    if best.dtype == object:
        best = np.array([min(int(d), LARGEST) for d in best], np.int64)
    return cluster, best


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        width = len(batch.column("v")[0]) if batch.num_rows else 1
        step = max(SLICE_VALUES // max(width, 1), 1)
        for low in range(0, batch.num_rows, step):
            part = batch.slice(low, step)
            flat = part.column("v").flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(part.num_rows, -1)


def cluster_sums(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(cluster, dim, n, total): how many vectors are nearest to a centroid, and their sums."""
    prepare(vectors.sparkSession)
    fixed = np.array(centroids, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(fixed), np.int64)
        sums = np.zeros(fixed.shape, object)
        for _, x in _matrices(batches):
            cluster, _ = nearest(x, fixed)
            n += np.bincount(cluster, minlength=len(fixed))
            small = np.abs(x.astype(np.float64)).max() * len(x) < 2.0**62
            for c in np.unique(cluster).tolist():
                part = x[cluster == c]
                sums[c] += (part if small else part.astype(object)).sum(0).astype(object)
        found = np.nonzero(n)[0]
        width = fixed.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(found, width), pa.int32()),
                pa.array(np.tile(np.arange(width), len(found)), pa.int32()),
                pa.array(np.repeat(n[found], width)),
                pa.array([str(x) for x in sums[found].ravel()], pa.string()),
            ],
            ["cluster", "dim", "n", "total"],
        )

    rows = vectors.select("v").mapInArrow(run, "cluster int, dim int, n bigint, total string")
    return rows.groupBy("cluster", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after a round: exact floors of the means; those without vectors stay."""
    out = [list(c) for c in centroids]
    for row in cluster_sums(vectors, centroids).collect():  # clusters x dimensions
        out[row["cluster"]][row["dim"]] = int(row["total"]) // row["n"]
    return out


def assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance)"""
    prepare(vectors.sparkSession)
    fixed = np.array(centroids, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches):
            cluster, distance = nearest(x, fixed)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED
) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance), centroids) of (vec_id, v) after `rounds` rounds."""
    vectors = materialize(vectors, "vectors")
    centroids = first_centroids(vectors, clusters, seed)
    if not centroids:
        empty = "vec_id bigint, cluster int, distance bigint"
        return vectors.sparkSession.createDataFrame([], empty), []
    for _ in range(rounds):
        after = moved(vectors, centroids)
        if after == centroids:
            break
        centroids = after
    return materialize(assign(vectors, centroids), "clustered"), centroids


def with_inertia(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds `cluster_inertia`, `inertia` and `centroid_sha256` to (vec_id, cluster, distance)."""
    hashes = [
        (i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids)
    ]
    named = rows.sparkSession.createDataFrame(hashes, "cluster int, centroid_sha256 string")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    total = sums.agg(F.sum("own").alias("every"))
    within = lambda name: F.least(F.col(name), F.lit(LARGEST)).cast("bigint")
    sums = sums.join(F.broadcast(total), F.lit(True)).join(F.broadcast(named), "cluster").select(
        "cluster", within("own").alias("cluster_inertia"), within("every").alias("inertia"), "centroid_sha256"
    )
    return rows.join(F.broadcast(sums), "cluster").select(  # a row per cluster
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
