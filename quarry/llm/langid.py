"""Language identification by interpolated Kneser-Ney character language models.

One trigram model per language, fitted on a bounded sample of labelled rows.
Each order keeps its n-grams in a sorted hash array with discounted
probabilities and back-off weights beside it; a merged array over all
languages' trigrams holds the finished log-probabilities, one column a
language, so a text costs one lookup per character. The prediction is the
language of least cross-entropy per character (ties: the first by name). A
rejection rule is calibrated on labelled rows kept out of the fit: a text is
rejected if its cross-entropy lies more than ``z`` standard deviations above
what its predicted language shows at that length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved
from quarry.llm.hashes import SortedHashes
from quarry.llm.points import folded

UND = "und"
DOCS_PER_LANG = 2000  # bound of the fitting sample, in documents a language (expected value; whole texts)
CALIBRATION_SHARE = 10  # one in so many sampled documents calibrates instead of fitting
MAX_LANGS = 10_000
REJECT_Z = 12.0
LEVEL_CHARS = 1000  # up to here the spread of cross-entropies falls with the length
MEDIAN_SQUARE = 0.4549  # of a standard normal
LEAST_SD = 0.1  # nats per character: texts of one language and length differ by no less
MOST_PER_CHAR = 6.0  # variance of one character's nats, at most: a few short texts fit no steeper line
CHUNK = 1 << 19  # characters scored at a time
SLICE_BYTES = 4 << 20  # of texts judged, and rows handed on, at a time
BITS = np.uint64(21)  # of a code point

def letters(text: str | None) -> np.ndarray:
    """Lower-case letters of the whole text, other runs as one space, two spaces before and one behind.

    Empty if the text is null or has no letter.
    """
    points = folded(text, "isalpha")
    if not len(points):
        return points
    pad = np.array([32], np.uint32)
    lead = [pad] if points[0] == 32 else [pad, pad]
    return np.concatenate([*lead, points] + ([] if points[-1] == 32 else [pad]))


def trigrams(points: np.ndarray) -> np.ndarray:
    """Packed trigrams; one for each character behind the two leading spaces."""
    p = points.astype(np.uint64)
    return (p[:-2] << (BITS + BITS)) | (p[1:-1] << BITS) | p[2:]


class KneserNey:
    """Interpolated Kneser-Ney of one language from its trigram counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, alphabet: int):
        low = (np.uint64(1) << BITS) - np.uint64(1)
        pair_mask = (np.uint64(1) << (BITS + BITS)) - np.uint64(1)
        last_pairs, continued = np.unique(keys & pair_mask, return_counts=True)  # distinct left neighbours
        ones, ones_continued = np.unique(last_pairs & low, return_counts=True)
        d3, d2, d1 = map(self.discount, (counts, continued, ones_continued))
        self.three, self.three_p = self.order(keys, counts, d3)
        self.pair_context, self.pair_weight = self.contexts(keys, counts, d3)
        self.two, self.two_p = self.order(last_pairs, continued, d2)
        self.one_context, self.one_weight = self.contexts(last_pairs, continued, d2)
        total = ones_continued.sum()
        self.base = d1 * len(ones) / total / alphabet
        self.one = SortedHashes(ones)
        self.one_p = ((ones_continued - d1) / total + self.base)[self.one.order]

    @staticmethod
    def discount(counts: np.ndarray) -> float:
        once, twice = int((counts == 1).sum()), int((counts == 2).sum())
        return once / (once + 2 * twice) if once and twice else 0.5

    @staticmethod
    def order(keys: np.ndarray, counts: np.ndarray, d: float) -> tuple[SortedHashes, np.ndarray]:
        _, inverse = np.unique(keys >> BITS, return_inverse=True)
        share = (counts - d) / np.bincount(inverse, counts)[inverse]
        found = SortedHashes(keys)
        return found, share[found.order]

    @staticmethod
    def contexts(keys: np.ndarray, counts: np.ndarray, d: float) -> tuple[SortedHashes, np.ndarray]:
        contexts, inverse = np.unique(keys >> BITS, return_inverse=True)
        weight = d * np.bincount(inverse) / np.bincount(inverse, counts)
        found = SortedHashes(contexts)
        return found, weight[found.order]

    def log_probability(self, keys: np.ndarray) -> np.ndarray:
        """Natural log-probability of each trigram's last character after its first two."""

        def pick(found: SortedHashes, values: np.ndarray, wanted: np.ndarray, absent: float) -> np.ndarray:
            rows = found.rows(wanted)
            return np.where(rows < 0, absent, values[rows])

        low = (np.uint64(1) << BITS) - np.uint64(1)
        pair_mask = (np.uint64(1) << (BITS + BITS)) - np.uint64(1)
        p = pick(self.one, self.one_p, keys & low, self.base)
        p = pick(self.two, self.two_p, keys & pair_mask, 0.0) + pick(self.one_context, self.one_weight, (keys >> BITS) & low, 1.0) * p
        p = pick(self.three, self.three_p, keys, 0.0) + pick(self.pair_context, self.pair_weight, keys >> BITS, 1.0) * p
        return np.log(p)


class LanguageModels:
    """The models of all learned languages."""

    def __init__(self, grams: dict[str, tuple[np.ndarray, np.ndarray]]):
        """``grams``: per language, distinct packed trigrams and their counts."""
        self.langs = sorted(grams)
        every = np.unique(np.concatenate([grams[x][0] for x in self.langs])) if self.langs else np.empty(0, np.uint64)
        alphabet = len(np.unique(every & ((np.uint64(1) << BITS) - np.uint64(1)))) + 1
        self.models = [KneserNey(*grams[x], alphabet) for x in self.langs]
        self.merged = SortedHashes(every)
        self.log_p = self._matrix(every)[self.merged.order] if self.langs else None

    def _matrix(self, keys: np.ndarray) -> np.ndarray:
        return np.column_stack([m.log_probability(keys) for m in self.models])

    def cross_entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: characters scored (0: no letters), and nats per character under every language."""
        count = np.zeros(len(texts), np.int64)
        total = np.zeros((len(texts), len(self.langs)))
        waiting, owners, size = [], [], 0

        def flush() -> None:
            keys = np.concatenate(waiting)
            rows = self.merged.rows(keys)
            new = np.flatnonzero(rows < 0)
            if len(new):
                distinct, inverse = np.unique(keys[new], return_inverse=True)
                matrix = self._matrix(distinct)
            at = 0
            for i, part in zip(owners, waiting, strict=True):
                mine = rows[at : at + len(part)]
                total[i] += self.log_p[mine[mine >= 0]].sum(axis=0)
                at += len(part)
            if len(new):
                starts = np.cumsum([0] + [len(part) for part in waiting])
                owner = np.searchsorted(starts, new, side="right") - 1
                np.add.at(total, np.array(owners)[owner], matrix[inverse])
            waiting.clear()
            owners.clear()

        for i, text in enumerate(texts):
            points = letters(text)
            if len(points) < 3 or not self.langs:
                continue
            keys = trigrams(points)
            count[i] = len(keys)
            for at in range(0, len(keys), CHUNK):
                part = keys[at : at + CHUNK]
                waiting.append(part)
                owners.append(i)
                size += len(part)
                if size >= CHUNK:
                    flush()
                    size = 0
        if waiting:
            flush()
        return count, -total / np.maximum(count, 1)[:, None]


def _sample(docs: DataFrame, train: Column, text_col: str, lang_col: str, id_col: str, docs_per_lang: int) -> DataFrame:
    """About ``docs_per_lang`` labelled rows a language, chosen by the hash of their id and text; ``calibrate`` marks the rows kept out of the fit.

    Rows without an id are chosen like others; of rows equal in id, text and language one is kept.
    """
    rows = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    counts = F.broadcast(docs.sparkSession.createDataFrame(counts, "lang string, n long"))  # texts are not shuffled
    share = F.shiftrightunsigned(F.col("pick"), 12) / F.lit(float(1 << 52))
    kept = rows.join(counts, "lang").withColumn("pick", F.xxhash64("id", "text")).where(share * F.col("n") < docs_per_lang)
    kept = kept.groupBy("lang", "pick").agg(F.first("text").alias("text"))
    return kept.select("lang", "text", (F.pmod("pick", F.lit(CALIBRATION_SHARE)) == 0).alias("calibrate"))


def fit(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", docs_per_lang: int = DOCS_PER_LANG) -> dict:
    """Fit one model a language on the rows where ``train`` holds.

    The sample (and with it the model, which travels through the driver and a
    broadcast) is bounded by ``docs_per_lang`` documents a language, not by the
    input. It is written once, so ``docs`` is read for the languages' counts and
    for the sample. Returns the model as plain arrays; with no labelled rows it knows
    no language and predicts ``und`` for everything.
    """
    spark = docs.sparkSession
    sample = saved(_sample(docs, train, text_col, lang_col, id_col, docs_per_lang), "language-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                points = letters(text.as_py())
                if len(points) >= 3:
                    by_lang.setdefault(lang, []).append(trigrams(points))
            for lang, parts in by_lang.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "key", "n"])

    fitted = sample.where(~F.col("calibrate")).drop("calibrate")
    grams = fitted.mapInArrow(count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    model = {"grams": {lang: (g["key"].to_numpy(np.int64).view(np.uint64), g["n"].to_numpy(np.int64)) for lang, g in grams.groupby("lang")}}

    shipped = spark.sparkContext.broadcast(model["grams"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = LanguageModels(shipped.value)
        for batch in batches:
            for part in _slices(batch["text"]):
                rows = batch.slice(*part)
                yield pa.RecordBatch.from_arrays([rows["lang"], _judged(ready, rows["text"])], ["lang", "found"])

    scored = sample.where(F.col("calibrate")).select("lang", "text").mapInArrow(judge, "lang string, found struct<lang:string,score:double,n:long,nats:double>")
    good = saved(scored.where((F.col("found.lang") == F.col("lang")) & (F.col("found.n") > 0)).select("lang", "found.n", "found.nats"), "calibration")
    middle = good.groupBy("lang").agg(F.median("nats").alias("mean"))
    # junk among the labelled rows must not widen the limits: squares far above the language's median square are left out
    squares = good.join(F.broadcast(middle), "lang").withColumn("y", F.pow(F.col("nats") - F.col("mean"), 2)).withColumn("level", F.col("y") * F.least("n", F.lit(LEVEL_CHARS)))
    typical = squares.groupBy("lang").agg(F.greatest(F.median("level") / MEDIAN_SQUARE, F.lit(LEAST_SD**2 * LEVEL_CHARS)).alias("typical"))
    inv = 1.0 / F.col("n")
    usual = squares.join(F.broadcast(typical), "lang").where(F.col("level") <= REJECT_Z**2 * F.col("typical"))
    sums = usual.groupBy("lang", "mean").agg(F.count("*").alias("m"), F.sum(inv).alias("x"), F.sum(inv * inv).alias("xx"), F.sum("y").alias("y"), F.sum(F.col("y") * inv).alias("xy")).toPandas()
    model["reject"] = {}
    for s in sums.itertuples():  # least squares: variance of the cross-entropy = a + b / length
        det = s.m * s.xx - s.x * s.x
        b = min(MOST_PER_CHAR, max(0.0, (s.m * s.xy - s.x * s.y) / det)) if det > 1e-18 else 0.0
        a = max(LEAST_SD**2, (s.y - b * s.x) / s.m)
        model["reject"][s.lang] = (float(s.mean), a, b)
    return model


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and length of runs of rows with about ``SLICE_BYTES`` of text each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64) + 1)
    at = 0
    while at < len(ends):
        size = max(1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right")) - at)
        yield at, size
        at += size


def _judged(models: LanguageModels, texts: pa.Array) -> pa.StructArray:
    n, nats = models.cross_entropies([t.as_py() for t in texts])
    best = nats.argmin(axis=1) if models.langs else np.zeros(len(n), np.int64)
    # posterior of the best language under equal priors, tempered: characters are not independent
    gap = nats - nats.min(axis=1, keepdims=True) if models.langs else np.zeros((len(n), 1))
    score = 1.0 / np.exp(-gap * np.sqrt(n)[:, None] * 4.0).sum(axis=1)
    score[n == 0] = 0.0
    names = [models.langs[b] if m and models.langs else UND for b, m in zip(best, n, strict=True)]
    least = nats.min(axis=1) if models.langs else np.zeros(len(n))
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score), pa.array(n), pa.array(least)], ["lang", "score", "n", "nats"])


def _scored(docs: DataFrame, model: dict, text_col: str, out: str = "found") -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ready = LanguageModels(shipped.value["grams"])
        for texts in batches:
            parts = [_judged(ready, texts.slice(*part)) for part in _slices(texts)]
            yield pa.concat_arrays(parts) if parts else _judged(ready, texts)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(out, F.arrow_udf(run, "lang string, score double, n long, nats double")(F.col(text_col)))


def predict(docs: DataFrame, model: dict, text_col: str = "text", z: float = REJECT_Z, out: str = "language") -> DataFrame:
    """Add ``out`` struct<lang, score, n, nats, rejected>: the predicted language of every whole text.

    ``lang`` is ``und`` (score 0, rejected) for a null text or one without a
    letter. ``nats`` is the cross-entropy per character, ``n`` the characters
    scored. Ties go to the first language by name; repeated rows repeat.
    """
    scored = _scored(docs, model, text_col, out)
    known = model.get("reject", {})
    found, n = F.col(f"{out}.lang"), F.greatest(F.col(f"{out}.n"), F.lit(1))
    reject = found == UND
    for lang, (mean, a, b) in sorted(known.items()):
        reject = reject | ((found == lang) & (F.col(f"{out}.nats") - mean > z * F.sqrt(F.lit(a) + F.lit(b) / n)))
    return scored.withColumn(out, F.col(out).withField("rejected", reject))


def recognised(docs: DataFrame, model: dict, text_col: str = "text", z: float = REJECT_Z) -> DataFrame:
    """The rows of ``docs`` that :func:`predict` does not reject, with their columns as they are.

    Rows stream through the judging tasks in slices of about ``SLICE_BYTES`` and
    only kept ones come back, so a task holds one batch beside a slice however
    long the texts are.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    known = model.get("reject", {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = LanguageModels(shipped.value["grams"])
        for batch in batches:
            for at, size in _slices(batch[text_col]):
                rows = batch.slice(at, size)
                found = _judged(ready, rows[text_col])
                lang = found.field("lang").to_pylist()
                mean, a, b = np.array([known.get(x, (np.inf, 0.0, 0.0)) for x in lang]).T
                n = np.maximum(found.field("n").to_numpy(), 1)
                limit = mean + z * np.sqrt(a + b / n)  # infinite for a language without calibration
                keep = (found.field("nats").to_numpy() <= limit) & (np.array(lang, dtype=object) != UND)
                yield rows.filter(pa.array(keep.astype(bool)))

    return docs.mapInArrow(run, docs.schema)
