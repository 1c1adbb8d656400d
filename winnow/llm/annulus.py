"""Centroid clustering in whole numbers, each vector compared only with the centroids of its annulus.

A centroid nearer to x than u has a norm within u of the norm of x. The centroids are
sorted by norm; the distance to those next to x's own norm is an upper bound u, two
binary searches give the centroids inside the annulus, and these are compared exactly.
Roots are rounded down and the annulus is widened by three, so no tie on its border is
lost.

A round is one scan: tasks hold the centroids (k x dims numbers) and give one row of
sums for each centroid. Nothing of the vectors is kept between rounds, so a lost
executor costs its tasks of the round at hand.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import set_aside, stored
from .vectors import finite, matrix

DIMS, SCALE = 64, 1024
#: below this, squared distances and dot products are exact as doubles (64 x 2^44 < 2^53)
EXACT = 1 << 22
#: sums travel in limbs of 32 bits, so that no sum over tasks overflows
LIMB = 32
LONG_MAX = (1 << 63) - 1


def whole(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x): doubles that hold whole numbers, or Python integers if some are beyond EXACT."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if (np.abs(y) < EXACT).all():
        return y
    exact = [[int(b) if math.isfinite(b) else int(a) * scale for a, b in zip(*row, strict=True)] for row in zip(x.tolist(), y.tolist(), strict=True)]
    return np.array(exact, object).reshape(x.shape)


def _root(n: np.ndarray) -> np.ndarray:
    return np.array([math.isqrt(v) for v in n], object) if n.dtype == object else np.floor(np.sqrt(n))


class Centroids:
    """Centroids sorted by norm."""

    def __init__(self, points: list[list[int]]):
        self.k = len(points)
        wide = any(abs(v) >= EXACT for p in points for v in p)
        self.exact = np.array(points, object).reshape(self.k, -1)
        norms = (self.exact * self.exact).sum(1)
        self.number = np.array(sorted(range(self.k), key=lambda j: (norms[j], j)))
        self.exact = self.exact[self.number]
        self.fast = None if wide else self.exact.astype(np.float64)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each row's nearest centroid, the smaller number where two are as near."""
        if x.dtype == object or self.fast is None:
            x, c = x if x.dtype == object else np.array([[int(v) for v in r] for r in x.tolist()], object).reshape(x.shape), self.exact
        else:
            c = self.fast
        norm_x, norm_c = (x * x).sum(1), (c * c).sum(1)
        root_x, root_c = _root(norm_x), _root(norm_c)
        far = lambda rows, j: norm_x[rows] - 2 * (x[rows] * c[j]).sum(1) + norm_c[j]
        every = np.arange(len(x))
        above = np.minimum(np.searchsorted(root_c, root_x), self.k - 1)
        bound = np.minimum(far(every, above), far(every, np.maximum(above - 1, 0)))
        reach = _root(bound) + 3
        first, last = np.searchsorted(root_c, root_x - reach, "left"), np.searchsorted(root_c, root_x + reach, "right")
        best, number = bound.copy(), np.full(len(x), self.k)
        for j in range(int(first.min(initial=self.k)), int(last.max(initial=0))):
            rows = np.flatnonzero((first <= j) & (j < last))
            d = norm_x[rows] - 2 * (x[rows] @ c[j]) + norm_c[j]
            better = (d < best[rows]) | ((d == best[rows]) & (self.number[j] < number[rows]))
            best[rows[better]], number[rows[better]] = d[better], self.number[j]
        return number, best


def _limbs(sums: np.ndarray) -> list[list[int]]:
    out = []
    while any(abs(v) >= 1 << LIMB for v in sums):
        out.append([int(v) & ((1 << LIMB) - 1) for v in sums])
        sums = np.array([int(v) >> LIMB for v in sums], object)
    return [*out, [int(v) for v in sums]]


def _moved(vectors: DataFrame, points: list[list[int]], dims: int, scale: int) -> list[list[int]]:
    """The centroids after one round: floor of the mean of each one's vectors; an empty one stays."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(points)
        total = np.zeros((len(points), dims + 1), object)
        for b in batches:
            if not len(b):
                continue
            x = whole(matrix(b.column("embedding"), dims), scale)
            number, _ = centroids.nearest(x)
            for j in np.unique(number).tolist():
                mine = x[number == j]
                total[j] += [*map(int, mine.sum(0)), len(mine)]
        rows = [(j, at, limb) for j in range(len(points)) if total[j][-1] for at, limb in enumerate(_limbs(total[j]))]
        yield pa.RecordBatch.from_pydict(
            {"cluster": pa.array([r[0] for r in rows], pa.int32()), "limb": pa.array([r[1] for r in rows], pa.int32()), "sums": pa.array([r[2] for r in rows], pa.list_(pa.int64()))}
        )

    parts = vectors.select("embedding").mapInArrow(sums, "cluster int, limb int, sums array<long>")
    found = parts.select("cluster", "limb", F.posexplode("sums").alias("d", "v")).groupBy("cluster", "limb", "d").agg(F.sum("v").alias("v")).collect()
    total: dict[tuple[int, int], int] = {}
    for r in found:
        total[r.cluster, r.d] = total.get((r.cluster, r.d), 0) + (r.v << (LIMB * r.limb))
    return [[total[j, d] // total[j, dims] for d in range(dims)] if (j, dims) in total else p for j, p in enumerate(points)]


def starts(vectors: DataFrame, k: int, seed: int, dims: int = DIMS, scale: int = SCALE) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``seed:vec_id``; null ids are never among them.

    Of rows with one id the smaller vector comes first.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.where(F.col("vec_id").isNotNull()).select(key.alias("key"), "embedding").orderBy("key", "embedding").limit(k).collect()
    return [[int(v) for v in whole(np.array([r.embedding], np.float64), scale)[0]] for r in rows]


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vectors(vec_id, embedding, ..)`` with cluster, distance, cluster_inertia, inertia and centroid_sha256.

    Kept are vectors of exactly ``dims`` components, none null, NaN or infinite; others are
    not returned, an empty or null vector among them. Each kept row counts, repeated rows as often as they
    occur, and a null vec_id is clustered without being a start. Fewer than k rows give as many
    centroids; an empty table, or one without any id, gives no rows. Distances and inertias beyond a long are null; centroids
    are exact at any size. Other columns stay, but for the vector and those named like an output. ``vectors`` is
    scanned once a round and twice more: store it first if it is dear to compute.
    """
    inner, restored = set_aside(vectors, ("vec_id", "embedding"))
    kept = inner.where((F.size("embedding") == dims) & finite("embedding"))
    outputs = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    points = starts(kept, k, seed, dims, scale)
    for _ in range(rounds if points else 0):
        before, points = points, _moved(kept, points, dims, scale)
        if points == before:  # a fixed point: further rounds change nothing
            break
    if not points:
        kept = kept.limit(0)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(points)
        for b in batches:
            number, far = centroids.nearest(whole(matrix(b.column("embedding"), dims), scale)) if len(b) else (np.zeros(0), np.zeros(0))
            far = pa.array([int(d) if d <= LONG_MAX else None for d in far.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(number.astype(np.int32)), far], [*b.schema.names, "cluster", "distance"])

    schema = T.StructType([*kept.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    out = stored(kept.mapInArrow(assigned, schema).drop("embedding"))
    full = F.count("distance") == F.count("*")
    sums = {r.cluster: r.s for r in out.groupBy("cluster").agg(F.when(full, F.sum(F.col("distance").cast("decimal(38,0)"))).alias("s")).collect()}
    as_long = lambda v: None if v is None or v > LONG_MAX else int(v)
    inertia = as_long(None if None in sums.values() else sum(sums.values()))
    facts = [(j, as_long(sums.get(j, 0)), inertia, hashlib.sha256(",".join(map(str, p)).encode()).hexdigest()) for j, p in enumerate(points)]
    facts = out.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return restored(out.join(F.broadcast(facts), "cluster").withColumn("embedding", F.lit(None)), outputs).drop("embedding")
