"""Centroid clustering against SQL and a brute-force version in Python's integers."""

import hashlib
import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from loculoom.llm import clustering

TABLE = "vec_id long, embedding array<double>, cluster int, distance string"


def brute(rows, k=16, rounds=3, dims=64, scale=64):
    kept = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), ",".join(map(str, r[1]))))
    c = [v for _, v in order[:k]]
    far = lambda v, m: sum((a - b) ** 2 for a, b in zip(v, m))
    near = lambda v: min(range(len(c)), key=lambda j: (far(v, c[j]), j))
    for _ in range(rounds):
        at = [near(v) for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), a in zip(kept, at) if a == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    at = [near(v) for _, v in kept]
    d = [far(v, c[a]) for (_, v), a in zip(kept, at)]
    top = lambda x: min(x, 2**63 - 1)
    inertia = [sum(top(x) for x, a in zip(d, at) if a == j) for j in range(len(c))]
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(((i, a, top(x), top(inertia[a]), top(sum(inertia)), sha[a]) for (i, _), a, x in zip(kept, at, d)), key=repr)


def told(spark, rows, **how):
    docs = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], TABLE).repartition(3)
    done = clustering.cluster_digest(*clustering.clustered(docs, **how))
    assert done.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, done.collect()), key=repr)


def test_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        path = f"/root/testdata/{sf}/embeddings.parquet"
        got = sorted(map(tuple, clustering.cluster_digest(*clustering.clustered(spark.read.parquet(path))).collect()), key=repr)
        con = duckdb.connect()
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
        assert got == sorted(map(tuple, con.execute(clustering.SQL).fetchall()), key=repr)


def odd_rows(n=120):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=64).astype(np.float32).astype(float).tolist()) for i in range(n)]
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, rows[6][1]), (7, rows[8][1]), (7, rows[9][1])]
    rows += [(200, None), (201, []), (202, [0.5] * 63), (203, [0.5] * 65), (204, [0.5] * 63 + [None]), (205, [math.nan] + [0.5] * 63), (206, [-math.inf] + [0.5] * 63)]
    return rows + [(300 + i, [(-1.0) ** i * 0.015625 * (i % 3)] * 64) for i in range(6)] + [(310, [-0.0] * 64)]


def test_odd_rows(spark):
    assert told(spark, odd_rows()) == brute(odd_rows())
    assert told(spark, odd_rows()[:9]) == brute(odd_rows()[:9])  # fewer vectors than centroids
    same = [(i, [0.25] * 64) for i in range(40)]  # centroids at one place: all but the first stay empty
    assert told(spark, same) == brute(same)
    assert told(spark, []) == [] and told(spark, [(1, None)]) == []


@pytest.mark.parametrize("size", [2.0**17, 2.0**19, 2.0**22, 2.0**25, 2.0**31, 2.0**60, 1e38, 1e300])
def test_integer_fallback(spark, size):
    rng = np.random.default_rng(7)
    rows = odd_rows(40) + [(1000 + i, (rng.normal(size=64) * size).tolist()) for i in range(30)] + [(2000, [size] * 64), (2001, [-size] * 63 + [0.01])]
    assert told(spark, rows) == brute(rows)


def test_guard():
    c = np.array([[2**25] * 64, [2**25 - 1] * 64])
    for shift in (0, 1, 2**10, 2**27, 2**29):
        x = np.array([[2**25 + shift] * 64, [1] * 64, [-(2**25)] * 64])
        cluster, far = clustering.nearest(x, c)
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, m)) for m in c] for v in x]
        assert far.tolist() == [min(w) for w in want] and cluster.tolist() == [w.index(min(w)) for w in want]


def test_sums_do_not_overflow():
    x = np.full((3000, 2), 2**53 - 1, np.int64)
    assert clustering.block_sums(x, np.zeros(3000, np.int64), 1) == ([3000], [[3000 * (2**53 - 1)] * 2])
