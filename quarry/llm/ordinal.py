"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text's hashed features (words, word beginnings, word shapes and repetition
marks, as 64-bit hashes) have one shared weight each; their sum eta moves a text along the scale
of grades, and ordered thresholds cut the scale: P(grade <= k) =
sigmoid(theta_k - eta). The fit minimises the negative log-likelihood with an
L2 penalty on the weights by L-BFGS. Scores are the expected grade and the tail
probability P(grade >= k) by which documents are selected.

The model is fitted on a sample of rated rows bounded by ``SAMPLE_ROWS``
(whole texts, chosen by the hash of their id); Spark extracts its features, and
the bounded feature lists are fitted on the driver. Scoring covers all rows,
each by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import LOWER_AZ
from quarry.llm.hashes import SortedHashes
from quarry.llm.words import word_hashes

SAMPLE_ROWS = 12_000  # bound of the fitting sample, in rated rows (expected value)
MIN_ROWS = 5  # sample rows that show a feature at least, else it has no weight
PENALTY = 1.0
STEPS = 60
# Byte classes. Words drop ASCII punctuation; shapes keep it and fold runs of letters and digits.
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WORD_BYTES = bytes(32 if c in PUNCTUATION else LOWER_AZ[c] for c in range(256))
SHAPE_BYTES = bytes(ord("X") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57 else ord("x") if 97 <= c <= 122 or c >= 128 else c for c in range(256))
FOLDED = np.frombuffer(b"Xx0", np.uint8)
STEM_BYTES = 5
STEM, SHAPE, REPEAT, VARIETY = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F), np.uint64(0x27BB2EE687B0B0FD)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature hashes of a whole text and their values, log(1 + count)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return np.empty(0, np.uint64), np.empty(0)
    folded = np.frombuffer(raw.translate(SHAPE_BYTES), np.uint8)
    run = np.concatenate([[False], folded[1:] == folded[:-1]]) & np.isin(folded, FOLDED)
    plain = raw.translate(WORD_BYTES)
    words, stems, shapes = word_hashes(plain), word_hashes(plain, STEM_BYTES), word_hashes(folded[~run].tobytes())
    marks = np.empty(0, np.uint64)
    if len(words) > 1:  # one mark per tenth reached
        again = int((words[1:] == words[:-1]).sum()) * 10 // len(words)
        same = 10 - len(np.unique(words)) * 10 // len(words)
        marks = np.concatenate([REPEAT + np.arange(again, dtype=np.uint64), VARIETY + np.arange(same, dtype=np.uint64)])
    keys, counts = np.unique(np.concatenate([words, stems ^ STEM, shapes ^ SHAPE, marks]), return_counts=True)
    return keys, np.log1p(counts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class CumulativeLink:
    """Shared weights and ordered thresholds."""

    def __init__(self, grades: list[int], keys: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.grades, self.keys, self.weights, self.thresholds = grades, keys, weights, thresholds

    @staticmethod
    def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], min_rows: int = MIN_ROWS, penalty: float = PENALTY, steps: int = STEPS) -> CumulativeLink | None:
        """``rows``: grade, feature hashes, values. None without rows."""
        if not rows:
            return None
        grades = sorted({g for g, _, _ in rows})
        y = np.searchsorted(grades, [g for g, _, _ in rows])
        every = np.concatenate([k for _, k, _ in rows])
        keys, seen = np.unique(every, return_counts=True)
        keys = keys[seen >= min_rows]
        column = np.searchsorted(keys, every).astype(np.int32)
        fine = column < len(keys)
        fine[fine] = keys[column[fine]] == every[fine]
        del every, seen
        column = column[fine].astype(np.int64)
        owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(k) for _, k, _ in rows])[fine].astype(np.int64)
        value = np.concatenate([v for _, _, v in rows])[fine].astype(np.float64)
        cuts = len(grades) - 1
        share = np.cumsum(np.bincount(y, minlength=cuts + 1))[:-1] / len(y)
        first = np.log(share / (1 - share))
        start = np.concatenate([np.zeros(len(keys)), first[:1], np.log(np.maximum(np.diff(first), 1e-3))])

        def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
            w, t = p[: len(keys)], p[len(keys) :]
            theta = np.concatenate([t[:1], t[:1] + np.cumsum(np.exp(t[1:]))]) if cuts else t
            eta = np.bincount(owner, value * w[column], len(y))
            ends = np.concatenate([[-np.inf], theta, [np.inf]])
            upper, lower = ends[y + 1] - eta, ends[y] - eta
            hi, lo = _sigmoid(upper), _sigmoid(lower)
            p_y = np.maximum(hi - lo, 1e-12)
            dh, dl = hi * (1 - hi) / p_y, lo * (1 - lo) / p_y
            g_eta = dh - dl  # of the negative log-likelihood
            g_theta = np.bincount(y + 1, -dh, cuts + 2)[1:-1] + np.bincount(y, dl, cuts + 2)[1 : cuts + 1] if cuts else np.empty(0)
            g_t = np.empty(cuts)
            for i in range(cuts):
                g_t[i] = g_theta[i:].sum() * (np.exp(t[i]) if i else 1.0)
            g_w = np.bincount(column, value * g_eta[owner], len(keys)) + penalty * w
            return -np.log(p_y).sum() + 0.5 * penalty * w @ w, np.concatenate([g_w, g_t])

        p = _lbfgs(loss, start, steps)
        t = p[len(keys) :]
        theta = np.concatenate([t[:1], t[:1] + np.cumsum(np.exp(t[1:]))]) if cuts else t
        return CumulativeLink(grades, keys, p[: len(keys)], theta)


def _lbfgs(loss, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    value, grad = loss(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, used = grad.copy(), []
        for s, d, rho in reversed(past):
            a = rho * (s @ q)
            used.append(a)
            q -= a * d
        if past:
            s, d, _ = past[-1]
            q *= (s @ d) / (d @ d)
        else:
            q /= max(1.0, np.linalg.norm(q))
        for (s, d, rho), a in zip(past, reversed(used), strict=True):
            q += s * (a - rho * (d @ q))
        size, slope = 1.0, grad @ q
        if slope <= 0:
            break
        while True:
            nxt = x - size * q
            new, new_grad = loss(nxt)
            if new <= value - 1e-4 * size * slope or size < 1e-6:
                break
            size *= 0.5
        s, d = nxt - x, new_grad - grad
        done = value - new < 1e-6 * max(1.0, abs(value))
        x, value, grad = nxt, new, new_grad
        if s @ d > 1e-12:
            past = [*past[1 - memory :], (s, d, 1.0 / (s @ d))]
        if done:
            break
    return x


def fit(docs: DataFrame, ratings: DataFrame, grade_col: str = "grade", text_col: str = "text", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> CumulativeLink | None:
    """Fit on the rows of ``docs`` that ``ratings`` (``id_col``, integer ``grade_col``) grades.

    Rows with a null id or grade are left out; an id rated twice counts twice.
    None if nothing is rated.
    """
    rated = ratings.select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade")).where(F.col("id").isNotNull() & F.col("grade").isNotNull())
    n = rated.count()
    if not n:
        return None
    share = F.shiftrightunsigned(F.xxhash64("id"), 12) / F.lit(float(1 << 52))
    picked = rated.where(share < min(1.0, sample_rows / n))
    if picked.count() <= 2 * sample_rows:  # proven small (unless one id holds most ratings): the texts stay where they are
        picked = F.broadcast(picked)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(picked, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()) for t in batch["text"]]
            keys = pa.array([k.view(np.int64) for k, _ in found], pa.list_(pa.int64()))
            values = pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch["id"].cast(pa.string()), batch["grade"], keys, values], ["id", "grade", "keys", "values"])

    listed = rows.mapInArrow(run, "id string, grade int, keys array<long>, values array<float>").toArrow().sort_by([("id", "ascending"), ("grade", "ascending")])
    lists = zip(listed["grade"].to_pylist(), listed["keys"], listed["values"], strict=True)
    return CumulativeLink.fit([(g, k.values.to_numpy().view(np.uint64), v.values.to_numpy()) for g, k, v in lists])


def score(docs: DataFrame, model: CumulativeLink | None, text_col: str = "text", out_col: str = "quality") -> DataFrame:
    """Add ``out_col`` struct<expected double, tails array<double>> to every row.

    ``expected`` is the expected grade; ``tails`` holds P(grade >= g) for every
    grade g but the lowest, in order. A null or empty text has no features.
    Null without a model.
    """
    shape = "expected double, tails array<double>"
    if model is None:
        return docs.withColumn(out_col, F.lit(None).cast(f"struct<{shape.replace(' double', ':double').replace(' array', ':array')}>"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shipped.value
        found = SortedHashes(m.keys)
        weights = m.weights[found.order]
        grades = np.array(m.grades, np.float64)
        for texts in batches:
            eta = np.zeros(len(texts))
            for i, t in enumerate(texts):
                keys, values = features(t.as_py())
                rows = found.rows(keys)
                hit = rows >= 0
                eta[i] = (weights[rows[hit]] * values[hit]).sum()
            tails = _sigmoid(eta[:, None] - m.thresholds[None, :])
            expected = grades[0] + tails @ np.diff(grades)
            lists = pa.ListArray.from_arrays(np.arange(len(eta) + 1, dtype=np.int32) * tails.shape[1], tails.ravel())
            yield pa.StructArray.from_arrays([pa.array(expected), lists], ["expected", "tails"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(out_col, F.arrow_udf(run, shape)(F.col(text_col)))


def select(docs: DataFrame, model: CumulativeLink | None, least_tail: float = 0.5, text_col: str = "text", out_col: str = "quality") -> DataFrame:
    """Scored rows whose probability of the top grade is ``least_tail`` or more (all rows without a model)."""
    scored = score(docs, model, text_col, out_col)
    top = F.try_element_at(F.col(f"{out_col}.tails"), F.lit(-1))
    return scored.where(top.isNull() | (top >= least_tail))
