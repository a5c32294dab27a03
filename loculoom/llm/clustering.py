"""Centroid clustering on exact integer components.

Vectors are cut to integers (floor of the component times ``scale``), so that sums, distances and centroids are exact and do not
depend on how rows are dealt.  The distances of a block of vectors to all centroids are one matrix product in float64,
|x|^2 - 2 x.c + |c|^2: every partial sum is an integer, and a block is done this way only if its largest component proves that all
of them stay below 2^53, where doubles are exact.  Rows that are larger fall back on 64-bit integers, and on Python's
unbounded integers where those could overflow.  Each scan partition sums up its vectors by cluster, and a ``treeAggregate`` adds the
partial sums; centroids (clusters x dimensions numbers) are all that the driver ever holds.  No vector is shuffled or written: a
round is a scan.

Defined results: only vectors of exactly ``dims`` components, none null, NaN or infinite, are kept; others have no row.  The first
centroids are the ``k`` kept vectors with the smallest SHA-256 of ``seed:vec_id`` (a null id is empty text), of equal ids those whose
components, written as text, come first; with fewer than ``k`` vectors there are fewer centroids.  Equal distances go to the
centroid of the smaller number; a centroid without vectors stays where it is.  Repeated rows are clustered one by one.  Sums and
distances above the range of a long are given as its largest value.  An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

CLUSTERS, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
#: Vectors of one matrix product.
BLOCK = 8_192
LONG = 2**63 - 1


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles, exact: int64, or Python integers where some do not fit."""
    if not x.size or np.abs(x).max() * scale < 2.0**53:
        return np.floor(x * scale).astype(np.int64)
    big = np.empty(x.size, object)
    # from 2^53 on a double is an integer
    big[:] = [int(v) * scale if abs(v) >= 2.0**53 else math.floor(int(v) * scale + (v - int(v)) * scale) for v in x.ravel().tolist()]
    return big.reshape(x.shape)


def kept_vectors(ids: pa.Array, column: pa.Array, dims: int, scale: int) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and integer components of the vectors that are kept, in blocks; rows too large for int64 come in blocks of their own."""
    for a in range(0, len(column), BLOCK):
        part, own = column.slice(a, BLOCK), ids.slice(a, BLOCK)
        whole = part.is_valid().to_numpy(zero_copy_only=False) & (part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) == dims)
        part, own = part.filter(pa.array(whole)), own.filter(pa.array(whole))
        x = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)  # a null becomes NaN
        fine = np.isfinite(x).all(1)
        x, names = x[fine], np.array(own.to_pylist(), object)[fine]
        small = np.abs(x).max(1, initial=0.0) * scale < 2.0**53
        for at in (small, ~small):
            if at.any():
                yield names[at].tolist(), integers(x[at], scale)


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest row of ``c`` to every row of ``x``, and its squared distance (int64 or Python integers), exact.

    Where the guard holds the cross products are one float64 matrix product; rows beyond it are worked out in integers."""
    dims = c.shape[1]
    top = int(np.abs(c).max(initial=0))
    most = np.abs(x).max(1, initial=0)
    # |x|^2, 2 x.c and |c|^2, and with them every partial sum, are at most dims * (|x| + |c|)^2
    exact = np.array([dims * (int(m) + top) ** 2 < 2**53 for m in most.tolist()], bool) if x.dtype == object or top >= 2**26 else dims * (np.minimum(most, 2**27).astype(np.float64) + top) ** 2 < 2.0**53
    cluster, distance = np.zeros(len(x), np.int64), np.zeros(len(x), object if not exact.all() else np.int64)
    if exact.any():
        a, b = x[exact].astype(np.float64), c.astype(np.float64)
        d = (a * a).sum(1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(1)
        best = d.argmin(1)  # the first of equal ones
        cluster[exact], distance[exact] = best, d[np.arange(len(best)), best].astype(np.int64)
    for i in np.flatnonzero(~exact).tolist():
        wide = dims * (int(most[i]) + top) ** 2 < 2**63
        gap = c.astype(np.int64 if wide else object) - x[i].astype(np.int64 if wide else object)
        d = (gap * gap).sum(1).tolist()
        cluster[i] = best = min(range(len(d)), key=d.__getitem__)
        distance[i] = d[best]
    return cluster, distance


Sums = tuple[list[int], list[list[int]]]


def block_sums(x: np.ndarray, cluster: np.ndarray, k: int) -> Sums:
    """Rows and component sums by cluster, as Python integers.  Components of int64 blocks are below 2^53."""
    n, sums = [0] * k, [[0] * x.shape[1] for _ in range(k)]
    for j in np.unique(cluster).tolist():
        rows = x[cluster == j]
        # 512 numbers below 2^53 add up below 2^62
        parts = (rows[a : a + 512].sum(0).tolist() for a in range(0, len(rows), 512))
        n[j], sums[j] = len(rows), [sum(c) for c in zip(*(rows.tolist() if x.dtype == object else parts))]
    return n, sums


def added(a: Sums, b: Sums) -> Sums:
    return [x + y for x, y in zip(a[0], b[0])], [[x + y for x, y in zip(p, q)] for p, q in zip(a[1], b[1])]


def first_centroids(vectors: DataFrame, k: int, dims: int, scale: int, seed: str) -> np.ndarray:
    """The start: ``k`` kept vectors by hash; every task sends its own ``k`` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), ",".join(map(str, v)))
            for b in batches for ids, x in kept_vectors(b.column(0), b.column(1), dims, scale) for i, v in zip(ids, x.tolist())
        )
        best = heapq.nsmallest(k, rows)
        yield pa.RecordBatch.from_pydict({"hash": pa.array([r[0] for r in best], pa.string()), "components": pa.array([r[1] for r in best], pa.string())})

    best = vectors.mapInArrow(run, "hash string, components string").orderBy("hash", "components").limit(k).collect()
    return fitted([[int(v) for v in r.components.split(",")] for r in best], dims)


def fitted(rows: list[list[int]], dims: int) -> np.ndarray:
    """Rows of integers, as int64 if they all fit."""
    fits = all(abs(v) < 2**62 for r in rows for v in r)
    return np.array(rows, np.int64 if fits else object).reshape(-1, dims)


def next_centroids(vectors: DataFrame, c: np.ndarray, scale: int) -> np.ndarray:
    """One round: assign, add up per partition, add the partial sums in a tree, and take the floor of the means."""
    k, dims = c.shape
    spread = vectors.sparkSession.sparkContext.broadcast(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = ([0] * k, [[0] * dims for _ in range(k)])
        for b in batches:
            for _, x in kept_vectors(b.column(0), b.column(1), dims, scale):
                total = added(total, block_sums(x, nearest(x, spread.value)[0], k))
        yield pa.RecordBatch.from_pydict({"sums": pa.array([pickle.dumps(total)], pa.binary())})

    parts = vectors.mapInArrow(run, "sums binary").rdd
    zero = ([0] * k, [[0] * dims for _ in range(k)])
    depth = max(2, math.ceil(math.log(max(2, parts.getNumPartitions()), 64)))
    n, sums = parts.treeAggregate(zero, lambda t, r: added(t, pickle.loads(r.sums)), added, depth)
    spread.destroy()
    return fitted([[s // n[j] for s in sums[j]] if n[j] else [int(v) for v in c[j]] for j in range(k)], dims)


def cluster_centroids(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: str = "1") -> np.ndarray:
    """The centroids of ``vectors(vec_id, embedding)`` after ``rounds`` rounds, k (or fewer) rows of integers."""
    vectors = vectors.select("vec_id", "embedding")
    c = first_centroids(vectors, k, dims, scale, seed)
    for _ in range(rounds if len(c) else 0):
        c = next_centroids(vectors, c, scale)
    return c


def assigned(vectors: DataFrame, c: np.ndarray, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster and distance of every kept row of ``vectors(vec_id, embedding)``, one scan."""
    spread, dims = vectors.sparkSession.sparkContext.broadcast(c), c.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, x in kept_vectors(b.column(0), b.column(1), dims, scale):
                cluster, distance = nearest(x, spread.value)
                far = distance if distance.dtype == np.int64 else [min(int(d), LONG) for d in distance]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(cluster, pa.int32()), pa.array(far, pa.int64())], names=["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: str = "1") -> tuple[DataFrame, DataFrame]:
    """Members (vec_id, cluster, distance) and clusters (cluster, size, cluster_inertia, centroid: components as text) of ``vectors``."""
    spark = vectors.sparkSession
    c = cluster_centroids(vectors, k, rounds, dims, scale, seed)
    if not len(c):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), spark.createDataFrame([], "cluster int, size long, cluster_inertia decimal(38,0), centroid string")
    # written: the members are used for the sums and for the result
    members = cut(assigned(vectors, c, scale))
    sums = members.groupBy("cluster").agg(F.count("*").alias("size"), F.sum(F.col("distance").cast("decimal(28,0)")).alias("cluster_inertia"))
    # k rows, whatever the input
    names = spark.createDataFrame([(j, ",".join(str(int(v)) for v in row)) for j, row in enumerate(c)], "cluster int, centroid string")
    groups = names.join(sums, "cluster", "left").select("cluster", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("cluster_inertia", F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)").alias("cluster_inertia"), "centroid")
    return members, groups


def cluster_digest(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Every member with the inertia of its cluster and of all, and the SHA-256 of its centroid; ``groups`` has at most k rows."""
    most = lambda x: F.least(x, F.lit(LONG).cast("decimal(38,0)")).cast("long")
    total = groups.agg(F.sum("cluster_inertia").cast("decimal(38,0)").alias("all"))
    told = groups.crossJoin(F.broadcast(total)).select(  # one row, so no product
        "cluster", most(F.col("cluster_inertia")).alias("cluster_inertia"), most(F.coalesce("all", F.lit(0).cast("decimal(38,0)"))).alias("inertia"), F.sha2(F.col("centroid").cast("binary"), 256).alias("centroid_sha256")
    )
    return members.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """k-means over lists; a cross of vectors with 16 centroids a round."""
    out = [
        "WITH k AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings "
        "WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), array_to_string(v, ',')) - 1 AS c, v AS m FROM k QUALIFY c < 16)",
    ]
    for t in range(4):
        out.append(
            f"d{t} AS (SELECT r, vec_id, v, c, CAST(list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i]))) AS BIGINT) AS d FROM k, c{t}), "
            f"a{t} AS (SELECT * FROM d{t} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"
        )
        if t < 3:
            out.append(
                f"s{t} AS (SELECT c, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n FROM a{t}, range(1, 65) AS g(i) GROUP BY c, i), "
                f"u{t} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM s{t} GROUP BY c), "
                f"c{t + 1} AS (SELECT c{t}.c, coalesce(u{t}.m, c{t}.m) AS m FROM c{t} LEFT JOIN u{t} ON c{t}.c = u{t}.c)"
            )
    return ", ".join(out) + (
        " SELECT vec_id, CAST(a3.c AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a3.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, "
        "sha256(array_to_string(m, ',')) AS centroid_sha256 FROM a3 JOIN c3 ON a3.c = c3.c"
    )


SQL = _sql()
