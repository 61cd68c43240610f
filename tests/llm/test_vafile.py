import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import vafile
from quarry.llm.queries import op13_centroids
from tests.conftest import SF_SMALL


def brute(rows, k, rounds, dims, scale):
    """Clusters of the vectors that take part: {id: [(cluster, distance)]} and the centroids."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    vectors = np.array([v for _, v in kept], np.int64)
    centroids = np.array([v for _, v in order[:k]], np.int64)

    def assign():
        gap = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        return gap.argmin(axis=1), gap.min(axis=1)

    for _ in range(rounds):
        best, _gap = assign()
        for j in range(len(centroids)):
            mine = vectors[best == j]
            if len(mine):
                centroids[j] = [int(t) // len(mine) for t in mine.sum(axis=0)]
    best, gap = assign()
    return sorted(((i, int(b), int(g)) for (i, _), b, g in zip(kept, best, gap, strict=True)), key=repr), centroids.tolist()


def vectors(n, dims, seed, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) + (i % 5) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_any_cells_give_the_exact_clusters(spark, bits):
    rows = vectors(300, 6, bits)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    done, clusters = vafile.cluster(df, k=7, rounds=4, dims=6, scale=16.0, bits=bits)
    want, centroids = brute(rows, 7, 4, 6, 16.0)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in done.collect()), key=repr) == want
    assert [c["components"] for c in clusters] == centroids
    assert sum(c["n"] for c in clusters) == 300


def test_fine_cells_spare_fetches(spark):
    rows = vectors(400, 6, 9, spread=0.05)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    _, clusters = vafile.cluster(df, k=5, rounds=4, dims=6, scale=256.0, bits=8)
    assert clusters[0]["fetched"][0] == 400 and clusters[0]["fetched"][-1] < 40


def test_odd_vectors_ties_repeats_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(40, 4, 2) + [(100, None), (101, [1.0, 2.0]), (102, [1.0, None, 2.0, 3.0]), (103, [nan, 0.0, 0.0, 0.0]), (104, [0.0, -inf, 0.0, 0.0])]
    rows += [(None, [0.5, 0.25, -0.75, 0.0]), (7, [1.0, 1.0, 1.0, 1.0]), (8, [9.0, 9.0, 9.0, 9.0]), (8, [9.0, 9.0, 9.0, 9.0]), (9, [-0.001] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(c) for c in ("row", "vec", "cells", "cluster", "mask", "id", "n")})
    done, _ = vafile.cluster(df, k=6, rounds=3, dims=4, scale=8.0, bits=2)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in done.collect()), key=repr) == brute(rows, 6, 3, 4, 8.0)[0]


def test_few_equal_or_no_vectors(spark):
    shape = "vec_id long, embedding array<double>"
    same = [(i, [1.5, -2.5]) for i in range(10)]
    done, clusters = vafile.cluster(spark.createDataFrame(same, shape), k=4, rounds=2, dims=2)
    assert {(r.cluster, r.distance) for r in done.collect()} == {(0, 0)} and [c["n"] for c in clusters] == [10, 0, 0, 0]
    done, clusters = vafile.cluster(spark.createDataFrame(same[:2], shape), k=40, rounds=1, dims=2)
    assert done.count() == 2 and len(clusters) == 2
    done, clusters = vafile.cluster(spark.createDataFrame([(1, None)], shape), dims=2)
    assert done.count() == 0 and clusters == [] and vafile.described(done, clusters).count() == 0


def test_a_component_too_large_raises(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="would not fit"):
        vafile.cluster(df, dims=2)


def test_cells_pack_and_unpack(spark):
    import pyarrow as pa

    cells = np.random.default_rng(0).integers(0, 8, (50, 13))
    assert (vafile.unpacked(pa.array(vafile.packed(cells, 3)), 13, 3) == cells).all()


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    want, centroids = brute(rows, 40, 5, 64, 256.0)
    got = op13_centroids(spark, SF_SMALL).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=repr) == want
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    for r in got:
        assert r.centroid_sha256 == digests[r.cluster]
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster) and r.inertia == sum(d for _, _, d in want)
