"""Centroid clustering over a VA-file (vector approximation file).

Every vector is kept twice: whole, in a table bucketed by row, and as a few
bits a dimension that name the cell its component lies in. A round of
clustering looks at the cells only: tables of the least and the greatest
squared distance between a cell and a centroid's component add up to an
interval of the distance to every centroid. A vector whose least interval lies
clear of the others is assigned from its cells. For the others the row and its
remaining candidates travel to the bucket that holds the whole vector, where
the exact distances decide; whole vectors never move. The sums behind the new
centroids are kept by differences, so a vector that is sure to stay in its
cluster is not fetched for them either.

All arithmetic is in integers and exact, so the cells (any number of bits)
change what is read and never the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.plans.storage import release, saved_buckets, saved_table

BITS = 7  # of a cell: on vectors spread evenly, fewer leave nearly every interval open
BUCKET_ROWS = 250_000  # vectors of a bucket, 64 MB of whole vectors at 64 dimensions
LARGEST = 1 << 27  # a component's largest size: sums of squared differences stay below 2^63
CHUNK = 4096  # rows looked up at a time


def quantised(vectors: DataFrame, dims: int, scale: float, id_col: str, vec_col: str) -> DataFrame:
    """``id`` and ``vec``, floor(scale * x) of every component, of the vectors that take part.

    Those have exactly ``dims`` components, none null, NaN or infinite.
    """
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    typed = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
    fits = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    typed = typed.where(F.coalesce((F.size("x") == dims) & fits, F.lit(False)))
    small = F.forall("x", lambda v: F.abs(v * scale) < LARGEST)
    checked = F.when(small, F.col("x")).otherwise(F.raise_error(F.lit(f"a component is over {LARGEST / scale} in size: distances would not fit a long")))
    return typed.select("id", F.transform(checked, lambda v: F.floor(v * scale).cast("int")).alias("vec"))


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the least sha256 of ``seed`` and id, in that order (ties: by components; null ids last)."""
    order = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256)
    rows = vectors.select(order.alias("hash"), "vec").orderBy(F.asc_nulls_last("hash"), "vec").limit(k).collect()
    return np.array([r["vec"] for r in rows], np.int64)


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def borders(vectors: DataFrame, dims: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Per dimension the least and greatest component of every cell, ``dims`` x 2^bits each.

    Cells split a normal distribution of the dimension's mean and deviation evenly;
    the outer ones reach to its exact minimum and maximum.
    """

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, total, square, n = None, None, 0.0, 0.0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch["vec"], dims, np.int64)
            low = v.min(axis=0) if low is None else np.minimum(low, v.min(axis=0))
            high = v.max(axis=0) if high is None else np.maximum(high, v.max(axis=0))
            f = v.astype(np.float64)
            total, square, n = total + f.sum(axis=0), square + (f * f).sum(axis=0), n + len(v)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(low), pa.array(high), pa.array(total), pa.array(square), pa.array([n] * dims, pa.int64())], ["dim", "low", "high", "total", "square", "n"])

    found = vectors.select("vec").mapInArrow(spans, "dim int, low long, high long, total double, square double, n long")
    rows = found.groupBy("dim").agg(F.min("low"), F.max("high"), F.sum("total"), F.sum("square"), F.sum("n")).orderBy("dim").collect()
    cells = 1 << bits
    steps = np.array([NormalDist().inv_cdf(i / cells) for i in range(1, cells)])
    least, most = np.empty((dims, cells), np.int64), np.empty((dims, cells), np.int64)
    for d, low, high, total, square, n in rows:
        mean = total / n
        sd = max(square / n - mean * mean, 0.0) ** 0.5
        inner = np.clip(np.floor(mean + sd * steps), low, high).astype(np.int64)
        most[d] = np.append(inner, high)
        least[d] = np.append(low, inner + 1)
    return least, most


def packed(cells: np.ndarray, bits: int) -> list[bytes]:
    """Rows of cell numbers as bit strings of ``bits`` a cell."""
    digits = (cells[:, :, None] >> np.arange(bits - 1, -1, -1)) & 1
    return [row.tobytes() for row in np.packbits(digits.reshape(len(cells), -1).astype(np.uint8), axis=1)]


def unpacked(column: pa.Array, dims: int, bits: int) -> np.ndarray:
    width = (dims * bits + 7) // 8
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)
    digits = np.unpackbits(raw, axis=1, count=dims * bits).reshape(len(raw), dims, bits)
    return digits @ (1 << np.arange(bits - 1, -1, -1))


class Intervals:
    """Lookup tables from cells to the interval of the squared distance to every centroid."""

    def __init__(self, least: np.ndarray, most: np.ndarray, centroids: np.ndarray):
        below = least[:, :, None] - centroids.T[:, None, :]  # dims x cells x centroids
        above = centroids.T[:, None, :] - most[:, :, None]
        self.low = np.maximum(np.maximum(below, above), 0) ** 2
        self.high = np.maximum(np.abs(below), np.abs(above)) ** 2

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """Per row, the centroids whose interval reaches down to the least upper end."""
        low = np.zeros((len(cells), self.low.shape[2]), np.int64)
        high = np.zeros_like(low)
        for d in range(cells.shape[1]):
            low += self.low[d][cells[:, d]]
            high += self.high[d][cells[:, d]]
        return low <= high.min(axis=1)[:, None]


def nearest(vectors: np.ndarray, centroids: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest candidate of every row (ties: the smaller number) and its squared distance, exactly."""
    rows, found = np.nonzero(candidates)
    gaps = np.empty(len(rows), np.int64)
    for at in range(0, len(rows), 1 << 15):
        part = slice(at, at + (1 << 15))
        step = vectors[rows[part]] - centroids[found[part]]
        gaps[part] = np.einsum("ij,ij->i", step, step)
    every = np.full(candidates.shape, np.iinfo(np.int64).max, np.int64)
    every[rows, found] = gaps
    best = every.argmin(axis=1)
    return best, every[np.arange(len(best)), best]


LOOKED = "row long, cells binary, old int, cluster int, mask binary"
FETCHED = "row long, id long, cells binary, cluster int, distance long, n long, total array<long>"


def _look(state: DataFrame, dims: int, bits: int, least: np.ndarray, most: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """Every row's cluster by its cells, or null and the mask of its candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        intervals = Intervals(least, most, centroids)
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                open_ = intervals.candidates(unpacked(batch["cells"], dims, bits))
                sure = open_.sum(axis=1) == 1
                masks = [None if s else m.tobytes() for s, m in zip(sure, np.packbits(open_, axis=1), strict=True)]
                cluster = pa.array(open_.argmax(axis=1), pa.int32(), mask=~sure)
                yield pa.RecordBatch.from_arrays([batch["row"], batch["cells"], batch["cluster"], cluster, pa.array(masks, pa.binary())], ["row", "cells", "old", "cluster", "mask"])

    return state.select("row", "cells", "cluster").mapInArrow(run, LOOKED)


def _fetch(looked: DataFrame, full: DataFrame, dims: int, centroids: np.ndarray) -> DataFrame:
    """Exact cluster and distance of the rows in ``looked``; per task and cluster, what their moves change in its count and sum (rows without ``row``)."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in FETCHED.split(", ")]
        counts, totals = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                v = _matrix(batch["vec"], dims, np.int64)
                sure = batch["cluster"].fill_null(-1).to_numpy(zero_copy_only=False)
                open_ = np.zeros((len(v), k), bool)
                known = np.flatnonzero(sure >= 0)
                open_[known, sure[known]] = True
                left = np.flatnonzero(sure < 0)
                if len(left):
                    masks = np.frombuffer(b"".join(batch["mask"].take(pa.array(left)).to_pylist()), np.uint8).reshape(len(left), -1)
                    open_[left] = np.unpackbits(masks, axis=1, count=k).astype(bool)
                best, gap = nearest(v, centroids, open_)
                old = batch["old"].to_numpy(zero_copy_only=False)
                moved = best != old
                np.add.at(counts, best[moved], 1)
                np.add.at(totals, best[moved], v[moved])
                left_behind = moved & (old >= 0)
                np.subtract.at(counts, old[left_behind], 1)
                np.subtract.at(totals, old[left_behind], v[left_behind])
                n = len(v)
                yield pa.RecordBatch.from_arrays([batch["row"], batch["id"], batch["cells"], pa.array(best, pa.int32()), pa.array(gap), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))], names)
        changed = np.flatnonzero(counts.astype(bool) | totals.any(axis=1))
        if len(changed):
            m, none = len(changed), pa.nulls(len(changed), pa.int64())
            sums = pa.array([t.tolist() for t in totals[changed]], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([none, none, pa.nulls(m, pa.binary()), pa.array(changed, pa.int32()), none, pa.array(counts[changed]), sums], names)

    # the rows asked for are the hashed side, a bucket's share of them; the whole vectors stream by in place
    asked = looked.hint("shuffle_hash")
    return full.join(asked, "row").select("row", "id", "vec", "cells", "old", "cluster", "mask").mapInArrow(run, FETCHED)


def cluster(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: float = 256.0,
    seed: str = "2:",
    bits: int = BITS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> tuple[DataFrame, list[dict]]:
    """Lloyd's clustering of integer vectors from ``k`` first vectors chosen by hash, exactly.

    Returns a table of one row per vector that takes part (``id_col``,
    ``cluster``, ``distance``, the squared distance to its centroid) and a list
    of the clusters (``cluster``, ``components``, ``n``, ``inertia``, and the
    number of vectors fetched in each round under ``fetched`` of the first).

    Vectors that are null, of another length, or hold a null, NaN or infinite
    component take no part; extra columns are ignored. Components are floored
    to integers after scaling, and one beyond ``LARGEST`` raises. Repeated rows
    are vectors of their own; a null id is allowed and comes last among the
    first centroids. With fewer than ``k`` vectors there are as many clusters;
    without any, both results are empty. Ties go to the cluster of the smaller
    number; an emptied cluster keeps its centroid.
    """
    if not 1 <= bits <= 8:
        raise ValueError("a cell has 1 to 8 bits")
    base = saved_table(quantised(vectors, dims, scale, id_col, vec_col).withColumn("row", F.monotonically_increasing_id()), "vectors")
    centroids = first_centroids(base, k, seed)
    if not len(centroids):
        return base.select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    k = len(centroids)
    n = base.count()
    buckets = max(base.sparkSession.sparkContext.defaultParallelism, -(-n // BUCKET_ROWS))
    full = saved_buckets(base.repartition(buckets, "row"), "vectors-by-row", "row", buckets)
    least, most = borders(base, dims, bits)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch["vec"], dims, np.int64)
            cells = np.column_stack([np.searchsorted(most[d, :-1], v[:, d]) for d in range(dims)])
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(packed(cells, bits), pa.binary()), pa.array(np.full(len(v), -1), pa.int32())], ["row", "cells", "cluster"])

    state = saved_table(base.select("row", "vec").mapInArrow(approximate, "row long, cells binary, cluster int"), "cells")
    release(base)
    spent: list[DataFrame] = [state]
    counts, totals, fetched = [0] * k, np.zeros((k, dims), dtype=object), []
    for _ in range(rounds):
        looked = saved_table(_look(state, dims, bits, least, most, centroids), "looked")
        stays = F.col("cluster").isNotNull() & (F.col("cluster") == F.col("old"))
        found = saved_table(_fetch(looked.where(~stays), full, dims, centroids), "fetched")
        moves = found.where(F.col("row").isNull()).select("cluster", "n", F.posexplode("total").alias("dim", "part"))
        for r in moves.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("part").alias("part")).collect():
            totals[r["cluster"], r["dim"]] += r["part"]
            if r["dim"] == 0:
                counts[r["cluster"]] += r["n"]
        fetched.append(found.where(F.col("row").isNotNull()).count())
        centroids = np.array([[t // counts[j] for t in totals[j]] if counts[j] else centroids[j] for j in range(k)], np.int64)
        state = looked.where(stays).select("row", "cells", "cluster").unionByName(found.where(F.col("row").isNotNull()).select("row", "cells", "cluster"))
        release(*spent)
        spent = [looked, found]
    last = _fetch(_look(state, dims, bits, least, most, centroids), full, dims, centroids)
    done = saved_table(last.where(F.col("row").isNotNull()).select(F.col("id").alias(id_col), "cluster", "distance"), "clustered")
    release(full, *spent)
    sums = {r["cluster"]: (r["n"], r["inertia"]) for r in done.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("distance").alias("inertia")).collect()}
    clusters = [{"cluster": j, "components": [int(c) for c in centroids[j]], "n": sums.get(j, (0, 0))[0], "inertia": sums.get(j, (0, 0))[1]} for j in range(k)]
    clusters[0]["fetched"] = fetched
    return done, clusters


def described(done: DataFrame, clusters: list[dict]) -> DataFrame:
    """The table of :func:`cluster` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` (k rows are broadcast)."""
    total = sum(c["inertia"] for c in clusters)
    rows = [(c["cluster"], c["inertia"], total, hashlib.sha256(",".join(map(str, c["components"])).encode()).hexdigest()) for c in clusters]
    about = done.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(about), "cluster")
