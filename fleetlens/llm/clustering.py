"""Dimension-sharded Lloyd: exact k-means over vectors cut into column blocks.

Vectors become integers, so distances, sums and ties are exact and the result
depends on neither order nor partitioning. Up to BLOCK_ROWS vectors form a row
block, cut into column blocks of SHARD_WIDTH dimensions. A round:

* every column block works out its part of the distances to its slice of the
  centroids;
* ``reduceByKey`` on the row block adds the parts, and the least sum gives each
  vector's centroid;
* the choices go back to the column blocks, which stay where they are (both
  sides share one partitioner), and every task adds up its own slices of the
  new centroids.

Column blocks are written once to the shared folder; no round builds on the
lineage of the one before. Only centroids and every task's sums for them, k
times dimensions whole numbers, pass through the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shared import stored

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3

BLOCK_ROWS = 4096
SHARD_WIDTH = 32

#: Whole numbers up to here square and add up exactly in double precision over a shard.
_EXACT = 1 << 22
_LONGEST = (1 << 63) - 1

_BLOCKS = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("width", pa.int32()), ("wide", pa.bool_()),
                     ("ids", pa.list_(pa.int64())), ("data", pa.binary())])


def usable(dimensions: int = DIMENSIONS) -> Column:
    """Whether ``embedding`` has exactly so many components, all of them finite numbers."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    return F.coalesce((F.size(x) == dimensions) & finite, F.lit(False))


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as Python integers, for values that no machine integer holds."""
    scaled = [math.floor(v * scale) if abs(v) < 1 << 50 else int(v) * scale for v in values.ravel().tolist()]
    return np.array(scaled, dtype=object).reshape(values.shape)


def _matrix(data: bytes, width: int, wide: bool, scale: int) -> np.ndarray:
    if wide:
        return _whole(np.frombuffer(data, dtype="<f8").reshape(-1, width), scale)
    return np.frombuffer(data, dtype="<i4").reshape(-1, width).astype(np.int64)


def column_blocks(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """block, shard, width, wide, ids, data: the column blocks, as a stored table.

    ``data`` holds 32-bit whole numbers; a block with a larger one is ``wide``
    and holds the components themselves. ``ids`` stands in shard 0 only.
    """
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                x = part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
                wide = bool(np.abs(x).max() >= (1 << 30) / scale)
                values = x.astype("<f8") if wide else np.floor(x * scale).astype("<i4")
                for shard, low in enumerate(range(0, dimensions, SHARD_WIDTH)):
                    own = np.ascontiguousarray(values[:, low:low + SHARD_WIDTH])
                    ids = part.column("vec_id").to_pylist() if not shard else None
                    row = ([block], [shard], [own.shape[1]], [wide], [ids], [own.tobytes()])
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _BLOCKS)], schema=_BLOCKS)
                block += 1

    held = vectors.where(usable(dimensions)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return stored(held.mapInArrow(
        cut, "block long, shard int, width int, wide boolean, ids array<long>, data binary"), "column_blocks")


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, dimensions: int = DIMENSIONS, scale: int = SCALE,
                    seed: int = SEED) -> np.ndarray:
    """The k vectors with the smallest hashes of their ids, in that order; ids tie by components, null ones come last."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("long").cast("string")), 256)
    held = vectors.where(usable(dimensions)).select(hashed.alias("h"), F.col("embedding").cast("array<double>").alias("x"))
    rows = held.orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()
    return _whole(np.array([r["x"] for r in rows], dtype="<f8").reshape(-1, dimensions), scale)


def _partial(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances over one shard's dimensions, exact."""
    if x.dtype != object and max(np.abs(x).max(), np.abs(centroids).max()) <= _EXACT:
        a, c = x.astype(float), centroids.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x.astype(object) - c) ** 2).sum(1) for c in centroids], axis=1)


def _nearest(distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller one on ties, and the distance."""
    chosen = distances.argmin(1)
    return chosen.astype(np.int32), distances[np.arange(len(chosen)), chosen]


def _sums(x: np.ndarray, chosen: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and sizes of the clusters within a block, as Python integers."""
    sums = np.stack([x[chosen == c].sum(0) for c in range(k)]).astype(object)
    return sums, np.bincount(chosen, minlength=k).astype(object)


def _moved(old: np.ndarray, sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Floored means; an empty cluster's centroid stays."""
    return np.stack([s // n if n else o for o, s, n in zip(old, sums, sizes)])


def _slices(centroids: np.ndarray) -> dict[int, np.ndarray]:
    return {s: centroids[:, low:low + SHARD_WIDTH] for s, low in enumerate(range(0, centroids.shape[1], SHARD_WIDTH))}


def _assigned(blocks: RDD, slices: dict[int, np.ndarray], parts: int, tasks: int) -> RDD:
    """(block, (numbers, distances))"""
    given = blocks.context.broadcast(slices)
    partial = blocks.coalesce(tasks).map(lambda b: (b[0][0], _partial(b[1], given.value[b[0][1]])))
    return partial.reduceByKey(add, parts).mapValues(_nearest)


def _updated(blocks: RDD, chosen: RDD, slices: dict[int, np.ndarray], parts: int, tasks: int) -> dict[int, np.ndarray]:
    """Every shard's next slice of the centroids."""
    k, shards = len(slices[0]), len(slices)
    told = chosen.flatMap(lambda b: [((b[0], s), b[1][0]) for s in range(shards)]).partitionBy(parts)

    def summed(rows: Iterable) -> Iterator[tuple]:
        numbers = {}
        for key, value in rows:
            if value.ndim == 1:
                numbers[key] = value
            else:
                yield key[1], _sums(value, numbers.pop(key), k)

    # Of one partitioner, so a partition reads its choices, then its blocks, in one Python process; a join takes three.
    # What comes back has the size of the centroids, once a task.
    total = told.union(blocks).coalesce(tasks).mapPartitions(summed).reduceByKeyLocally(lambda a, b: (a[0] + b[0], a[1] + b[1]))
    return {s: _moved(slices[s], *t) for s, t in total.items()}


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
            scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of every usable vector, as a stored table, and the final centroids.

    ``vectors`` needs vec_id and embedding (an array of numbers); other columns
    are ignored, whatever their names. Vectors that are null, of another length
    or hold a null or non-finite component are left out. Null and repeated ids
    and repeated vectors are vectors like any other. With fewer than k vectors
    there are as many centroids; without any there are no rows. Distances of
    components beyond a million stay exact; in the table one that exceeds a
    64-bit number stands as the largest such number.
    """
    spark = vectors.sparkSession
    slices = _slices(first_centroids(vectors, k, dimensions, scale, seed))
    table = column_blocks(vectors, dimensions, scale)
    if not len(slices[0]):
        none = spark.createDataFrame([], "vec_id long, cluster int, distance long")
        return none, np.zeros((0, dimensions), dtype=object)
    rows = table.select("block", "shard", "width", "wide", "data").rdd
    parts = max(rows.getNumPartitions(), spark.sparkContext.defaultParallelism)
    blocks = rows.map(lambda r: ((r["block"], r["shard"]), _matrix(r["data"], r["width"], r["wide"], scale))).partitionBy(parts)
    # Every task starts Python, also over an empty partition: there are no more of them than column blocks.
    tasks = min(parts, table.count())
    for _ in range(rounds):
        slices = _updated(blocks, _assigned(blocks, slices, parts, tasks), slices, parts, tasks)
    found = _assigned(blocks, slices, parts, tasks).map(
        lambda b: (b[0], b[1][0].tolist(), [min(d, _LONGEST) for d in b[1][1].tolist()]))
    found = spark.createDataFrame(found, "block long, cluster array<int>, distance array<long>", verifySchema=False)
    held = table.where("shard = 0").select("block", "ids").join(found, "block")
    each = held.select(F.explode(F.arrays_zip(F.col("ids").alias("vec_id"), "cluster", "distance")).alias("v")).select("v.*")
    return stored(each, "clusters"), np.concatenate([slices[s] for s in sorted(slices)], axis=1)


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Add cluster_inertia, inertia (sums of distances) and centroid_sha256 to a clustering."""
    spark = found.sparkSession
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")

    def total(of: Column) -> Column:
        return F.least(F.sum(of), F.lit(_LONGEST).cast("decimal(38,0)")).cast("decimal(19,0)")

    sums = found.groupBy("cluster").agg(total(F.col("distance").cast("decimal(28,0)")).alias("own"))
    # One row a centroid: k is a parameter, not data.
    of_all = sums.agg(total(F.col("own").cast("decimal(28,0)")).alias("every"))
    known = sums.join(F.broadcast(of_all)).join(F.broadcast(named), "cluster")
    return found.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", F.col("own").cast("long").alias("cluster_inertia"),
        F.col("every").cast("long").alias("inertia"), "centroid_sha256")
