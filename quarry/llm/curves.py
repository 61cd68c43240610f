"""Approximate nearest neighbours by inner product over shifted Hilbert curves.

Inner product becomes distance on a sphere by one added coordinate, so that
close points have large products. Each of ``curves`` orderings projects the
points onto a few random directions, shifts them, cuts the space into cells and
orders the cells along a Hilbert curve. Spark range-partitions every ordering,
numbers its rows from end to end and cuts them into blocks of ``block_rows``; a query is compared with the
rows of its own block and ``reach`` blocks on either side, in double precision on
the original vectors. The orderings' findings merge and the nearest remain.

How wide the windows must be depends on the vectors: clustered ones need few
rows, evenly spread ones a share of the table. So at every size the windows are
measured: the exact neighbours of up to ``SAMPLE`` query points are found by one
pass over all points, and the curves and reach taken that cost least of those
that hold ``RECALL`` of these neighbours.

The orderings carry point numbers only. Vectors join them once the curves are
chosen, in the type they came in, and move once for each curve in use.

Exact copies of a vector are one point of the curves with the ids they need
(the ``k`` + 1 smallest: no query can use more), so a vector in a third of all
rows neither fills its neighbours' windows nor meets in one task. Every group a
task holds is a block of rows and about as many query points at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from quarry.llm.common import saved

CURVES, DIRECTIONS, BITS = 8, 6, 10
MEASURED_CURVES = 4  # at most, where windows are measured: vectors move once for each
BLOCK_ROWS, REACH = 2048, 3
SAMPLE, RECALL = 256, 0.95  # query points that windows are measured on, and the share of their neighbours to hold
WIDE_ROWS = 16384  # of a block in wide windows, and query points that meet it at once
BAND = 32  # blocks whose findings merge first
SEED = 20


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of integer cells (n x dims, ``bits`` bits each) along the Hilbert curve.

    The transposed index is worked out bit plane by bit plane: undo the
    rotations and reflections from the top plane down, then Gray-encode.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    plane = 1 << (bits - 1)
    while plane > 1:
        low = plane - 1
        for i in range(dims):
            high = (x[i] & plane) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, 0) ^ swap
            x[i] ^= swap
        plane >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    plane = 1 << (bits - 1)
    while plane > 1:
        flip ^= np.where((x[-1] & plane) != 0, plane - 1, 0)
        plane >>= 1
    x ^= flip
    out = np.zeros_like(flip)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _placed(points: DataFrame, width: int, longest: float, curves: int, directions: int, bits: int) -> DataFrame:
    """Each point's (and query point's) key on every curve: ``curve``, ``key``."""
    rng = np.random.default_rng(SEED)
    axes = rng.standard_normal((curves, width + 1, directions)) / np.sqrt(width + 1)
    shifts = rng.random((curves, directions))
    spread = longest / np.sqrt(width + 1)  # of a projected coordinate

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            v = _matrix(batch["vector"])
            norm = np.sqrt((v * v).sum(axis=1))
            for query in (False, True):
                rows = np.flatnonzero(batch["asked"].to_numpy(zero_copy_only=False)) if query else np.arange(len(v))
                if not len(rows):
                    continue
                if query:  # only its direction counts
                    spot = np.column_stack([v[rows] * (longest / norm[rows])[:, None], np.zeros(len(rows))])
                else:
                    spot = np.column_stack([v, np.sqrt(np.maximum(0.0, longest * longest - norm * norm))])
                for c in range(curves):
                    y = spot @ axes[c] / spread  # about standard normal
                    cells = np.clip((y + 4.0 + shifts[c]) / 9.0 * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
                    part = batch.take(pa.array(rows))
                    extra = [np.full(len(rows), c, np.int32), hilbert(cells, bits), np.full(len(rows), query)]
                    yield pa.RecordBatch.from_arrays([part["point"], *map(pa.array, extra)], ["point", "curve", "key", "query"])

    return points.select("point", "vector", "asked").mapInArrow(run, "point long, curve int, key long, query boolean")


def _numbered(placed: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Each row's number along its curve (``row``, the same under every partition count), and each curve's rows."""
    spark = placed.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = placed.repartitionByRange(parts, "curve", "key", "point", "query").sortWithinPartitions("curve", "key", "point", "query")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            curve = batch["curve"].to_numpy()
            local = np.empty(len(curve), np.int64)
            for c in np.unique(curve):
                rows = np.flatnonzero(curve == c)
                local[rows] = np.arange(len(rows)) + seen.get(int(c), 0)
                seen[int(c)] = seen.get(int(c), 0) + len(rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local)], [*batch.schema.names, "local"])

    shape = "point long, curve int, key long, query boolean, local long"
    table = saved(ranged.mapInArrow(number, shape).drop("key").withColumn("part", F.spark_partition_id()), "curves")
    counts = table.groupBy("curve", "part").agg((F.max("local") + 1).alias("rows")).orderBy("curve", "part").collect()  # a row per curve and partition
    before, sizes = [], {}
    for r in counts:
        before.append((r["curve"], r["part"], sizes.get(r["curve"], 0)))
        sizes[r["curve"]] = sizes.get(r["curve"], 0) + r["rows"]
    offsets = spark.createDataFrame(before, "curve int, part int, offset long")
    return table.join(F.broadcast(offsets), ["curve", "part"]).withColumn("row", F.col("local") + F.col("offset")), sizes


def _blocks(table: DataFrame, sizes: dict[int, int], block_rows: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """Blocks of ``block_rows`` rows, numbered over all curves, and each curve's first and last block."""
    ends, at = {}, 0
    for c, rows in sorted(sizes.items()):
        ends[c] = (at, at + (rows - 1) // block_rows)
        at = ends[c][1] + 1
    return table.withColumn("block", F.floor(F.col("row") / block_rows) + _per_curve({c: a for c, (a, _) in ends.items()})), ends


def _per_curve(values: dict[int, int]) -> Column:
    return F.element_at(F.create_map(*[F.lit(int(x)) for pair in values.items() for x in pair]), F.col("curve")).cast("long")


def _nearest_of(points: DataFrame, asked: list[Row], k: int) -> list[Row]:
    """``q``, ``point``, ``score``, ``n`` (its ids): by brute force, the ``k`` + 1 nearest points of each of a few query points."""
    names, q = np.array([r["point"] for r in asked], np.int64), np.array([r["vector"] for r in asked], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, scores = np.empty((len(q), 0), np.int64), np.empty((len(q), 0), np.int64), np.empty((len(q), 0))
        for batch in batches:
            v = _matrix(batch["vector"])
            for at in range(0, len(v), 4096):  # bounded scratch
                here = slice(at, min(len(v), at + 4096))
                wide = (len(q), here.stop - at)
                scores = np.concatenate([scores, q @ v[here].T], axis=1)
                ids = np.concatenate([ids, np.broadcast_to(batch["point"].to_numpy()[here], wide)], axis=1)
                sizes = np.concatenate([sizes, np.broadcast_to(batch["n"].to_numpy()[here], wide)], axis=1)
                if scores.shape[1] > k + 1:
                    best = np.argpartition(-scores, k, axis=1)[:, : k + 1]
                    scores, ids, sizes = (np.take_along_axis(x, best, axis=1) for x in (scores, ids, sizes))
        found = [np.repeat(names, scores.shape[1]), ids.ravel(), scores.ravel(), sizes.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["q", "point", "score", "n"])

    found = points.select("point", "vector", F.size("ids").cast("long").alias("n")).mapInArrow(run, "q long, point long, score double, n long")
    place = Window.partitionBy("q").orderBy(F.desc("score"), "point")
    return found.withColumn("at", F.row_number().over(place)).where(F.col("at") <= k + 1).orderBy("q", "at").collect()


def _measured(points: DataFrame, table: DataFrame, k: int, curves: int, block_rows: int) -> tuple[int, int]:
    """The curves and rows on either side that cost least of those that hold ``RECALL`` of a sample's exact neighbours."""
    asked = points.where("asked").orderBy(F.xxhash64("point"), "point").limit(SAMPLE).select("point", "vector").collect()
    pairs, left = [], {}
    for r in _nearest_of(points, asked, k):  # nearest first
        own = r["q"] == r["point"]
        n = min(left.get(r["q"], k), r["n"] - own)
        left[r["q"]] = left.get(r["q"], k) - n
        if n:
            pairs.append((r["q"], r["point"], n))
    met = table.sparkSession.createDataFrame(sorted({x for q, p, _ in pairs for x in (q, p)}), "long").select(F.col("value").alias("point"))
    places = table.select("point", "query", "curve", "row").join(F.broadcast(met), "point").collect()  # a few thousand points, a row per curve
    rows = {(r["point"], r["query"], r["curve"]): r["row"] for r in places}
    gaps = np.array([[abs(rows[q, True, c] - rows[p, False, c]) for c in range(curves)] for q, p, _ in pairs]).reshape(-1, curves)
    gaps = np.repeat(gaps, [n for _, _, n in pairs], axis=0)
    if not len(gaps):
        return curves, REACH * block_rows
    options = []
    for used in range(1, curves + 1):
        needed = np.sort(gaps[:, :used].min(axis=1))[int(np.ceil(RECALL * len(gaps))) - 1]
        wide = max(REACH * block_rows, int(needed))
        options.append((used * (2 * wide + block_rows), used, wide))
    return min(options)[1:]


def _compare(k: int):
    """Within one block: for each query point the ``k`` + 1 nearest ids, by exact score, ties to smaller ids."""

    def run(met: pa.Table) -> pa.Table:
        rows, asked = met.filter(pc.invert(met["query"])), met.filter(met["query"])
        band = met["to"][0].as_py() // BAND
        out_q, out_ids, out_scores = [], [], []
        if len(rows) and len(asked):
            order = np.argsort(rows["point"].to_numpy())
            v = _matrix(rows["vector"].combine_chunks())[order]
            ids = [rows["ids"][int(i)].values.to_numpy() for i in order]
            sizes = np.array([len(x) for x in ids])
            q = _matrix(asked["vector"].combine_chunks())
            keep = min(k + 1, len(v))
            for at in range(0, len(q), 128):  # bounded scratch
                products = q[at : at + 128] @ v.T
                kth = np.partition(products, len(v) - keep, axis=1)[:, len(v) - keep]
                for i, least in enumerate(kth):
                    near = np.flatnonzero(products[i] >= least - 1e-9 * max(1.0, abs(least)))
                    exact = (v[near] * q[at + i]).sum(axis=1)
                    flat = np.concatenate([ids[n] for n in near])
                    scores = np.repeat(exact, sizes[near])
                    best = np.lexsort((flat, -scores))[: k + 1]
                    out_q.append(asked["point"][at + i].as_py())
                    out_ids.append(flat[best])
                    out_scores.append(scores[best])
        return pa.table({"point": pa.array(out_q, pa.int64()), "band": pa.array([band] * len(out_q), pa.int64()), "ids": pa.array(out_ids, pa.list_(pa.int64())), "scores": pa.array(out_scores, pa.list_(pa.float64()))})

    run.__annotations__ = {"met": pa.Table, "return": pa.Table}
    return run


def neighbours(vectors: DataFrame, asked: Column, k: int = 20, curves: int = CURVES, directions: int = DIRECTIONS, bits: int = BITS, block_rows: int = BLOCK_ROWS, reach: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows found for every row where ``asked`` holds, its own id left out.

    Returns ``query_id``, ``rank`` (from 1), ``id_col``, ``score`` (the inner
    product in double precision), nearest first, ties to the smaller id; all
    candidates if there are fewer than k. Rows with a null id, or a null, empty
    or zero vector, or one with null or non-finite components, take no part; nor
    do vectors whose length is not the most frequent one. Repeated rows count
    once. Other columns are ignored. An empty table gives an empty one.

    Without a ``reach`` the windows are measured (at most ``curves`` orderings and
    ``MEASURED_CURVES``);
    a given one holds for any size, whatever the recall.
    """
    spark = vectors.sparkSession
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    typed = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("vector"), F.coalesce(asked, F.lit(False)).alias("asked"))
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    good = typed.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite).withColumn("squares", squares).where(F.col("squares") > 0)
    width = good.groupBy(F.size("vector").alias("w")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").first()
    if width is None:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    width = width["w"]
    good = good.where(F.size("vector") == width)
    longest = float(np.sqrt(good.agg(F.max("squares")).first()[0]))
    rows = good.select("id", "vector", "asked").dropDuplicates(["id", "vector"])
    # the smallest ids of every distinct vector; the limit is applied in each task before the shuffle
    place = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(place)).where(F.col("n") <= k + 1)
    held = few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    wanted = rows.where("asked").groupBy("vector").agg(F.lit(True).alias("asked"))
    points = held.join(wanted, "vector", "left").select(F.col("ids")[0].alias("point"), "ids", "vector", F.coalesce("asked", F.lit(False)).alias("asked"))
    points = saved(points, "points")

    queries = points.where("asked").count()
    curves = min(curves, MEASURED_CURVES) if reach is None else curves
    table, sizes = _numbered(_placed(points, width, longest, curves, directions, bits))
    if reach is None:
        used, rows_wide = _measured(points, table, k, curves, block_rows)
        table, sizes = table.where(F.col("curve") < used), {c: x for c, x in sizes.items() if c < used}
        # larger blocks where windows are wide: fewer copies of the query points
        block_rows = min(max(block_rows, min(WIDE_ROWS, (1 << 20) // width)), max(block_rows, rows_wide // REACH))
        reach = -(-rows_wide // block_rows)
    table, ends = _blocks(table, sizes, block_rows)
    first, last = (_per_curve({c: e[i] for c, e in ends.items()}) for i in (0, 1))
    window = F.sequence(F.greatest(first, F.col("block") - reach), F.least(last, F.col("block") + reach))
    chunks = -(-min(queries, (2 * reach + 1) * block_rows) // WIDE_ROWS) or 1  # of the query points that meet a block
    # a candidate goes to its own block (once per chunk), a query point to every block of its window
    met = table.withColumn("to", F.explode(F.when(F.col("query"), window).otherwise(F.array("block"))))
    every = F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))
    met = met.withColumn("chunk", F.explode(F.when(F.col("query"), F.array(F.pmod(F.xxhash64("point"), F.lit(chunks).cast("long")))).otherwise(every)))
    met = met.select("to", "chunk", "point", "query").join(points.select("point", "ids", "vector"), "point")
    found = met.groupBy("to", "chunk").applyInArrow(_compare(k), "point long, band long, ids array<long>, scores array<double>")

    def best(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for parts in batches:
            out = []
            for part in parts:
                lists = part.values
                ids = lists.field("ids").flatten().to_numpy()
                scores = lists.field("scores").flatten().to_numpy()
                order = np.lexsort((ids, -scores))
                ids, scores = ids[order], scores[order]
                _, once = np.unique(ids, return_index=True)
                once = np.sort(once)[: k + 1]
                out.append([{"id": int(i), "score": float(s)} for i, s in zip(ids[once], scores[once], strict=True)])
            yield pa.array(out, pa.list_(pa.struct([("id", pa.int64()), ("score", pa.float64())])))

    best.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    nearest_of = F.arrow_udf(best, "array<struct<id:long,score:double>>")
    lists = F.collect_list(F.struct("ids", "scores")).alias("parts")
    if sum(b - a + 1 for a, b in ends.values()) > 2 * BAND:  # at most BAND lists, then one per band
        banded = found.groupBy("point", "band").agg(lists).select("point", nearest_of("parts").alias("near"))
        found = banded.select("point", F.col("near.id").alias("ids"), F.col("near.score").alias("scores"))
    nearest = found.groupBy("point").agg(lists).select("point", nearest_of("parts").alias("near"))
    askers = rows.where("asked").select(F.col("id").alias("query_id"), "vector").join(points.select("point", "vector"), "vector").select("query_id", "point")
    own = askers.join(nearest, "point").select("query_id", F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k).alias("near"))
    listed = own.select("query_id", F.posexplode("near").alias("at", "x"))
    return listed.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias(id_col), F.col("x.score").alias("score"))
