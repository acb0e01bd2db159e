"""K-means over integer vectors whose dot products are popcounts of bit planes.

A vector of 64 components becomes integers, written in two's complement with as
many bits as its largest one needs.  Bit ``i`` of all 64 components is one
unsigned 64-bit word, its ``i``-th plane.  Then

    v . c  =  sum over i, j of  w_i * w_j * popcount(v's plane i & c's plane j)

where ``w_i`` is ``2^i``, and ``-2^i`` for the top plane, which holds the signs.  So
dot products, and with the stored squared norms also squared distances, are exact.

A round is one pass over the planes: each task adds up its own vectors of every
cluster and returns a row a cluster, so a cluster may hold any share of all
vectors, and what meets in the driver is the centroids alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH = 64  # components, one bit of a word each
#: Integers below this give distances that fit into 64 bits.
LARGEST = 1 << 28
ROWS = 4096


def bits_of(values: np.ndarray) -> np.ndarray:
    """Bits that each row of (n, 64) integers needs in two's complement."""
    return 1 + np.frexp(np.maximum(values.max(1), ~values.min(1)).astype(float))[1]


def planes_of(values: np.ndarray, bits: int | None = None) -> np.ndarray:
    """(n, bits) words of (n, 64) integers; the last plane is for the signs."""
    bits = bits or int(bits_of(values).max(initial=1))
    place = np.uint64(1) << np.arange(WIDTH, dtype=np.uint64)
    held = (values[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return (held.astype(np.uint64) * place).sum(2, dtype=np.uint64)


def weights_of(bits: int) -> np.ndarray:
    """What a bit of each plane counts: powers of two, the top one negative."""
    w = np.int64(1) << np.arange(bits, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def values_of(planes: np.ndarray) -> np.ndarray:
    """The (n, 64) integers of (n, bits) words."""
    held = (planes[:, :, None] >> np.arange(WIDTH, dtype=np.uint64)) & np.uint64(1)
    return np.einsum("b,nbd->nd", weights_of(planes.shape[1]), held.astype(np.int64))


def dots(planes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(n, k) dot products of n vectors with k centroids, both as planes."""
    out = np.zeros((len(planes), len(centroids)), np.int64)
    for i, a in enumerate(weights_of(planes.shape[1])):
        for j, b in enumerate(weights_of(centroids.shape[1])):
            out += a * b * np.bitwise_count(planes[:, i, None] & centroids[None, :, j]).astype(np.int64)
    return out


def nearest(planes: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smallest) and the squared distance to it."""
    far = norms[:, None] + (centroids ** 2).sum(1)[None, :] - 2 * dots(planes, planes_of(centroids))
    at = far.argmin(1)
    return at, far[np.arange(len(far)), at]


def _plane_rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch with equally many planes, at most ``ROWS`` at a time: (places, planes)."""
    raw = batch.column("planes")
    sizes = np.asarray(pa.compute.binary_length(raw))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        for i in range(0, len(at), ROWS):
            some = at[i:i + ROWS]
            words = np.frombuffer(b"".join(raw.take(pa.array(some)).to_pylist()), "<u8")
            yield some, words.reshape(len(some), -1)


def bit_planes(table: DataFrame, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, norm, planes) of the rows whose vector has 64 components, none null or non-finite: ``floor(scale * x)``."""
    x = F.col(vector).cast("array<double>")
    whole = (F.size(x) == WIDTH) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    kept = table.where(F.coalesce(whole, F.lit(False))).select(F.col(key).cast("long").alias(key), x.alias("x"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column("x")
        scaled = np.floor(scale * np.asarray(column.flatten(), np.float64).reshape(len(column), WIDTH))
        if np.abs(scaled).max(initial=0) >= LARGEST:
            raise ValueError(f"a component times {scale} is beyond {LARGEST}: squared distances would not fit into 64 bits")
        values = scaled.astype(np.int64)
        need = bits_of(values)
        rows: list[bytes] = [b""] * len(values)
        for bits in np.unique(need):
            at = np.flatnonzero(need == bits)
            for i, words in zip(at.tolist(), planes_of(values[at], int(bits))):
                rows[i] = words.astype("<u8").tobytes()
        return pa.RecordBatch.from_arrays([batch.column(key), pa.array((values ** 2).sum(1)), pa.array(rows, pa.binary())],
                                          [key, "norm", "planes"])

    common.bounded_batches(table.sparkSession)
    return common.mapped(kept, f"`{key}` long, norm long, planes binary", run)


def first_centroids(planes: DataFrame, k: int, salt: str, key: str = "vec_id") -> np.ndarray:
    """The ``k`` vectors whose ``salt`` and key hash to the smallest SHA-256 (null key: as empty; ties: by planes)."""
    named = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    rows = planes.orderBy(named, "planes").limit(k).collect()
    return np.concatenate([np.zeros((0, WIDTH), np.int64),
                           *[values_of(np.frombuffer(r.planes, "<u8")[None]) for r in rows]])


def cluster_sums(planes: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of each cluster and their sum; a task gives one row a cluster, whatever it holds."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, WIDTH), np.int64)
        for batch in batches:
            norms = np.asarray(batch.column("norm"))
            for some, words in _plane_rows(batch):
                at, _ = nearest(words, norms[some], centroids)
                n += np.bincount(at, minlength=k)
                np.add.at(total, at, values_of(words))
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(np.repeat(held, WIDTH).astype(np.int32)),
            "component": pa.array(np.tile(np.arange(WIDTH, dtype=np.int32), len(held))),
            "n": pa.array(np.repeat(n[held], WIDTH)),
            "total": pa.array(total[held].ravel()),
        })

    sums = planes.select("norm", "planes").mapInArrow(common.released(run), "cluster int, component int, n long, total long") \
        .groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    n, total = np.zeros(k, np.int64), np.zeros((k, WIDTH), np.int64)
    for r in sums:
        n[r.cluster] = r.n
        total[r.cluster, r.component] = r.total
    return n, total


def k_means(table: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, salt: str = "2:", key: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """One row a kept vector: key, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Each round assigns every vector to its nearest centroid (ties: the smaller
    number) and moves each centroid that has vectors to the floor of their
    mean; vectors are assigned once more at the end.  Vectors of another length,
    null ones and those with a null or non-finite component are left out, so are other
    columns.  Null keys and repeated rows are vectors like any other.  Fewer than
    ``k`` vectors give as many centroids; an empty table gives no rows.  A
    component of ``LARGEST / scale`` or more raises an error.
    """
    spark = table.sparkSession
    planes = common.stored(bit_planes(table, scale, key, vector), "planes")
    centroids = first_centroids(planes, k, salt, key)
    for _ in range(rounds):
        n, total = cluster_sums(planes, centroids)
        held = n > 0
        centroids = np.where(held[:, None], total // np.maximum(n, 1)[:, None], centroids)

    def assign(batch: pa.RecordBatch) -> pa.RecordBatch:
        cluster, distance = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
        norms = np.asarray(batch.column("norm"))
        for some, words in _plane_rows(batch):
            cluster[some], distance[some] = nearest(words, norms[some], centroids)
        return pa.RecordBatch.from_arrays([batch.column(key), pa.array(cluster), pa.array(distance)], [key, "cluster", "distance"])

    found = common.stored(common.mapped(planes, f"`{key}` long, cluster int, distance long", assign), "assigned")
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    whole = sum(r.cluster_inertia for r in inertia)
    shas = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    # one row a cluster, so of a size that k bounds
    facts = spark.createDataFrame([(r.cluster, r.cluster_inertia, whole, shas[r.cluster]) for r in inertia],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster") \
        .select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
