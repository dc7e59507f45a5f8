"""Operator 12: ball k-means on integer vectors, exact.

A cluster is a ball: its centroid, and a radius that bounds how far its members are from it. Only centroids nearer than
twice the radius can take a member away; those are its neighbours, in order of distance. Members nearer to their own
centroid than half the way to its nearest neighbour are the stable core and are compared with nothing. The others lie in
annuli: a member is compared with just those neighbours that are at most twice as far from its centroid as it is itself.
Everything is integers, so that bounds, ties and sums are exact.

The members of a round, with their cluster and distance, are a table in the shared folder. Sums and greatest distances
of a cluster are aggregated before the shuffle; centroids, neighbours and radii are k rows on the driver. A new radius is
not measured but bounded by the old one plus the way that the centroid went.

Defined results: vectors that are null, of another length, or hold null or non-finite components take no part and are not
returned. Scaled components beyond +-LIMIT count as +-LIMIT, so that every distance fits a long. Rows of an equal id are
vectors of their own, a null id is assigned but is no seed; equal seed hashes go by the vectors' own order. With fewer
vectors than k there are fewer centroids. Other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

K, ROUNDS, SCALE, SIZE = 16, 3, 64, 64
LIMIT = 1 << 27
#: Below this magnitude sums of squares over 64 components are exact in double precision.
DOUBLE = 1 << 21


def quantise(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, size: int = SIZE) -> DataFrame:
    """(vec_id, x) of the vectors that take part, x as integers."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.transform(F.col(vector), lambda v: v.cast("double")).alias("x")).where(F.size("x") == size)
    rows = rows.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    return rows.select("vec_id", F.transform("x", lambda v: F.floor(F.least(F.greatest(v * scale, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int")).alias("x"))


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x and of c, exact."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < DOUBLE:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * a @ b.T).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


def balls(centroids: np.ndarray, radii: list[int] | None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each ball the neighbours that can take a member away, nearest first, and their squared distances."""
    between = distances(centroids, centroids)
    out = []
    for i in range(len(centroids)):
        order = np.lexsort((np.arange(len(centroids)), between[i]))
        order = order[order != i]
        if radii is not None:  # d(i, j) <= 2 r, in squares
            order = order[[int(d) <= 4 * radii[i] ** 2 for d in between[i][order]]]
        out.append((order, between[i][order]))
    return out


def assign(x: np.ndarray, own: np.ndarray | None, centroids: np.ndarray, near: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and squared distance of each row, ties to the smaller number, and how many distances that took."""
    if own is None:
        d = distances(x, centroids)
        best = d.argmin(axis=1)
        return best, d[np.arange(len(x)), best], d.size
    best, least, work = own.copy(), np.zeros(len(x), np.int64), len(x)
    for i in np.unique(own):
        rows = np.flatnonzero(own == i)
        least[rows] = d = distances(x[rows], centroids[i : i + 1])[:, 0]
        order, apart = near[i]
        rim = d.copy()  # a neighbour further off than twice the distance to the own centroid can't be as near
        for j, gap in zip(order.tolist(), apart.tolist(), strict=True):
            at = np.flatnonzero(rim >= -(-gap // 4))
            if not len(at):
                break  # only the stable core is left
            other = distances(x[rows[at]], centroids[j : j + 1])[:, 0]
            work += len(at)
            now, number = least[rows[at]], best[rows[at]]
            win = (other < now) | ((other == now) & (j < number))
            least[rows[at[win]]], best[rows[at[win]]] = other[win], j
    return best, least, work


def _columns(batch) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column("x")
    return batch.column("vec_id"), x.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(x), -1)


def _assigned(members: DataFrame, centroids: np.ndarray, radii: list[int] | None) -> DataFrame:
    near, first = balls(centroids, radii), "cluster" not in members.columns

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                ids, x = _columns(batch)
                own = None if first else batch.column("cluster").to_numpy().astype(np.int64)
                best, least, _ = assign(x, own, centroids, near)
                yield pa.RecordBatch.from_arrays([ids, batch.column("x"), pa.array(best, pa.int32()), pa.array(least, pa.int64())], ["vec_id", "x", "cluster", "distance"])

    return members.mapInArrow(run, "vec_id long, x array<int>, cluster int, distance long")


def _stats(members: DataFrame, size: int) -> list:
    """(cluster, n, greatest distance, component sums): at most k rows."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            _, x = _columns(batch)
            cluster, d = batch.column("cluster").to_numpy(), batch.column("distance").to_numpy()
            for i in np.unique(cluster):
                mine = cluster == i
                yield pa.RecordBatch.from_pylist([{"cluster": int(i), "n": int(mine.sum()), "far": int(d[mine].max()), "sums": x[mine].sum(axis=0).tolist()}], pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("far", pa.int64()), ("sums", pa.list_(pa.int64()))]))

    parts = members.mapInArrow(run, "cluster int, n long, far long, sums array<long>")
    sums = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(size)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("far").alias("far"), *sums).collect()


def seeds(members: DataFrame, k: int = K) -> np.ndarray:
    """The k vectors whose hashes of `1:<vec_id>` are smallest, in order of hash."""
    hashed = members.where("vec_id is not null").select(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).alias("h"), "x")
    rows = hashed.orderBy("h", "x").limit(k).collect()  # k rows
    return np.array([r.x for r in rows], np.int64)


def cluster_vectors(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, size: int = SIZE) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part."""
    spark = vectors.sparkSession
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    with Scratch() as tables:
        members = tables.write(quantise(vectors, key, vector, scale, size))
        centroids = seeds(members, k)
        if not len(centroids):  # nothing, or null ids alone
            return spark.createDataFrame([], out)
        radii: list[int] | None = None
        for _ in range(rounds):
            before = members
            members = tables.write(_assigned(before, centroids, radii))
            tables.drop(before)
            moved, radii = centroids.copy(), [0] * len(centroids)
            for r in _stats(members, size):
                moved[r.cluster] = [int(r[f"s{c}"]) // r.n for c in range(size)]
                way = int(((moved[r.cluster] - centroids[r.cluster]) ** 2).sum())
                radii[r.cluster] = math.isqrt(r.far) + math.isqrt(way) + 2  # rounded up
            centroids = moved
        last = tables.write(_assigned(members, centroids, radii).drop("x"))
        sums = last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
        total = sum(int(r.s) for r in sums)
        fits = lambda n: min(int(n), (1 << 63) - 1)
        facts = [(r.cluster, fits(r.s), fits(total), hashlib.sha256(",".join(map(str, centroids[r.cluster].tolist())).encode()).hexdigest()) for r in sums]
        small = F.broadcast(spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))  # k rows
        return tables.keep(last.join(small, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
