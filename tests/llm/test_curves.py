import random

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import curves
from quarry.llm.queries import op7_neighbours
from tests.conftest import SF_ORACLE


def brute(rows, asked, k):
    """Rows (id, vector) already clean and distinct."""
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], np.float64)
    out = []
    for at in np.flatnonzero([asked(i) for i in ids]):
        scores = (v * v[at]).sum(axis=1)
        others = np.flatnonzero(ids != ids[at])
        best = others[np.lexsort((ids[others], -scores[others]))[:k]]
        out += [(int(ids[at]), r + 1, int(ids[b]), float(scores[b])) for r, b in enumerate(best)]
    return out


def test_hilbert_visits_every_cell_by_unit_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = curves.hilbert(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_small_tables_are_searched_whole_with_copies_ties_and_awkward_rows(spark):
    rng = random.Random(1)
    base = [[rng.gauss(0, 1) for _ in range(5)] for _ in range(30)]
    rows = [(i, base[i % 30] if i < 60 else base[3]) for i in range(150)]  # one vector in most rows
    rows.append((200, [2.5 * x for x in base[0]]))
    odd = [(300, None), (301, [0.0] * 5), (302, [1.0, None, 1.0, 1.0, 1.0]), (303, [float("nan")] * 5), (304, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (None, base[1]), (305, []), (306, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "c", "c") for i, v in [*rows, *odd, rows[0], rows[7]]], "vec_id long, embedding array<double>, id string, point string").repartition(3)
    got = [tuple(r) for r in curves.neighbours(df, F.col("vec_id") % 10 == 0, k=7).collect()]
    assert sorted(got) == sorted(brute(rows, lambda i: i % 10 == 0, 7))


def test_fewer_candidates_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in curves.neighbours(df, F.lit(True), k=20).collect())
    assert got == sorted(brute([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], lambda i: True, 20))
    assert curves.neighbours(df.limit(0), F.lit(True)).count() == 0
    assert curves.neighbours(df.where("vec_id = 0"), F.lit(True)).count() == 0


def test_recall_with_bounded_windows_on_clustered_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16))
    v = centres[rng.integers(0, 40, 3000)] + 0.15 * rng.standard_normal((3000, 16))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id) for r in curves.neighbours(df, F.col("vec_id") % 50 == 0, k=10, block_rows=64, reach=2).collect()}
    want = {(q, i) for q, _, i, _ in brute(rows, lambda i: i % 50 == 0, 10)}
    assert len(got & want) >= 0.9 * len(want)


def test_windows_hold_the_same_rows_under_every_partition_count(spark):
    rng = np.random.default_rng(6)
    v = rng.standard_normal((1500, 16))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    before, got = spark.conf.get("spark.sql.shuffle.partitions"), {}
    try:
        for parts in (8, 1000):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found = curves.neighbours(df, F.col("vec_id") % 50 == 0, k=10, curves=4, block_rows=128, reach=2)
            spark.conf.set("spark.sql.shuffle.partitions", 8)
            got[parts] = sorted(tuple(r) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[8] == got[1000]
    want = {(q, i) for q, _, i, _ in brute(rows, lambda i: i % 50 == 0, 10)}
    assert len({(q, i) for q, _, i, _ in got[1000]} & want) >= 0.8 * len(want)


def test_windows_follow_the_vectors_until_recall_holds(spark, monkeypatch):
    rng = np.random.default_rng(7)
    even = rng.standard_normal((4000, 16))
    centres = rng.standard_normal((80, 16))
    clustered = centres[np.arange(4000) % 80] + 0.05 * rng.standard_normal((4000, 16))
    chosen, measured = [], curves._measured
    monkeypatch.setattr(curves, "_measured", lambda *x: (chosen.append(measured(*x)), chosen[-1])[1])
    for v in (even, clustered):
        rows = [(i, (x / np.linalg.norm(x)).tolist()) for i, x in enumerate(v)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = {(r.query_id, r.vec_id) for r in curves.neighbours(df, F.col("vec_id") % 40 == 0, k=10, curves=4, block_rows=16).collect()}
        want = {(q, i) for q, _, i, _ in brute(rows, lambda i: i % 40 == 0, 10)}
        assert len(got & want) >= 0.9 * len(want)
    (even_curves, even_rows), (few_curves, few_rows) = chosen
    assert few_curves * few_rows < even_curves * even_rows and few_curves * (2 * few_rows + 16) < 4000


def test_query(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in op7_neighbours(spark, SF_ORACLE).collect())
    want = sorted(brute(rows, lambda i: i % 20 == 0, 20))
    hits = len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want})
    assert len(got) == len(want) and hits >= 0.9 * len(want)
