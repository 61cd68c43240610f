"""Substring dedup by seed and extend.

Seeds. A document's word k-grams are hashed and winnowed: every window of
``min_words`` words elects the least of the k-grams in it as its anchor, so two
equal windows elect equal anchors at equal offsets. Anchors are counted over
all documents; one that occurs once cannot seed a match.

Extension. Around an anchor that occurs again the match is extended both ways
to the full windows that elected it: each such window is hashed whole and
counted over all documents. Windows that occur once fail the extension; the
rest are repeats, and runs of overlapping repeats are the maximal repeats.

Both counts run as partial and final aggregations that carry the least row and
position of a hash. For a hash that occurs once these *are* its place, so the
places to rule out come straight from the aggregation: no pair of occurrences
is ever joined, a passage in a third of all documents costs one partial row a
task, and a group of thousands of copies costs what as many other rows do.
Texts are shuffled once (the exchange is reused by the last join).

Seeds are compared by 64 bits: a collision only keeps a window for the next
step. Windows are compared by 128 bits, two hashes that mix whole words in
order (``words.joined``); with n distinct windows the chance that any two collide
is about n^2 / 2^129.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import numbered
from quarry.llm.words import window_hashes, word_hashes

SEED_WORDS = 10  # words of a seed


def elected(words: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every seed, and per window the position of the seed that it elects."""
    seeds = window_hashes(words, seed)
    n = len(words) - width + 1
    if n <= 0:
        return seeds, np.empty(0, np.int64)
    span = width - seed + 1
    out = np.empty(n, np.int64)
    for at in range(0, n, 1 << 18):  # bounded scratch for very long texts
        part = sliding_window_view(seeds[at : min(n, at + (1 << 18)) + span - 1], span)
        out[at : at + len(part)] = part.argmin(axis=1) + np.arange(at, at + len(part))
    return seeds, out


def _raw(text: pa.Scalar) -> bytes:
    return (text.as_py() or "").encode("utf-8", "surrogatepass")


def _rows(batches: Iterator[pa.RecordBatch], per_row: Callable[[dict], tuple[np.ndarray, ...]], names: list[str], flush: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Positions and hashes of what ``per_row`` finds in each row, in bounded batches."""
    for batch in batches:
        columns, size = [[] for _ in range(len(names) + 2)], 0

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in columns], ["row", "pos", *names])  # noqa: B023
            for x in columns:  # noqa: B023
                x.clear()
            return made

        for i, row in enumerate(batch["row"].to_pylist()):
            pos, *hashes = per_row({c: batch[c][i] for c in batch.schema.names})
            if len(pos):
                for column, values in zip(columns, [np.full(len(pos), row, np.int64), pos.astype(np.int32), *(h.view(np.int64) for h in hashes)], strict=True):
                    column.append(values)
                size += len(pos)
            if size >= flush:
                yield out()
                size = 0
        if size:
            yield out()


def _hashes(found: DataFrame) -> list[str]:
    return [c for c in found.columns if c not in ("row", "pos")]


def _alone(found: DataFrame, name: str) -> DataFrame:
    """Per row, the positions whose hash (all columns but the place) occurs nowhere else."""
    once = found.groupBy(*_hashes(found)).agg(F.count("*").alias("n"), F.min("row").alias("row"), F.min("pos").alias("pos")).where(F.col("n") == 1)
    return once.groupBy("row").agg(F.collect_list("pos").alias(name))


def _judged(found: DataFrame) -> DataFrame:
    """Per row, the positions whose hash occurs nowhere else, and those where a hash occurs again but here first (least row and position)."""
    each = found.groupBy(*_hashes(found)).agg(F.count("*").alias("n"), F.min(F.struct("row", "pos")).alias("at")).select("at.row", "at.pos", "n")
    lone, first = (F.collect_list(F.when(which, F.col("pos"))) for which in (F.col("n") == 1, F.col("n") > 1))  # nulls are left out
    return each.groupBy("row").agg(lone.alias("lone_windows"), first.alias("first_windows"))


def _candidates(words: np.ndarray, alone: pa.Scalar, width: int, seed: int) -> np.ndarray:
    """Start positions of the windows whose elected seed occurs again somewhere."""
    seeds, chosen = elected(words, width, seed)
    single = np.zeros(len(seeds), bool)
    if alone.is_valid:
        single[alone.values.to_numpy()] = True
    return np.flatnonzero(~single[chosen]) if len(chosen) else chosen


def repeats(docs: DataFrame, min_words: int = 50, seed_words: int = SEED_WORDS, text_col: str = "text", id_col: str = "doc_id", keep_first: bool = False) -> DataFrame:
    """Find and cut passages of ``min_words`` or more words that occur again, in any document.

    Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are. Returns per input
    row: ``id_col``, ``n_words``, ``n_removed``, ``kept`` (the words outside
    every repeat, joined by one space) and ``spans`` (the maximal repeats:
    ``start`` and ``length`` in words). All occurrences are cut; with
    ``keep_first``, no word of a window's first occurrence is (the least id and
    position, or least row where ids do not name rows), so that every passage
    stays whole in one place, and ``spans`` are the runs cut. Null and empty
    texts have no words. Repeated rows are further occurrences like any other;
    null and repeated ids are allowed. Other columns are ignored.
    """
    width, seed = min_words, min(seed_words, min_words)
    texts = numbered(docs, id_col, text_col)
    plain = texts.select("row", "text")

    def seeds_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
        hashes, chosen = elected(word_hashes(_raw(row["text"])), width, seed)
        places = np.unique(chosen)
        return places, hashes[places]

    seeds = plain.mapInArrow(lambda b: _rows(b, seeds_of, ["hash"]), "row long, pos int, hash long")
    seeded = texts.join(_alone(seeds, "lone_seeds"), "row", "left")

    def windows_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
        raw = _raw(row["text"])
        words = word_hashes(raw)
        places = _candidates(words, row["lone_seeds"], width, seed)
        if not len(places):
            return places, np.empty(0, np.uint64), np.empty(0, np.uint64)
        return places, window_hashes(words, width)[places], window_hashes(word_hashes(raw, lane=1), width)[places]

    # the same columns as in the last join, so that both share one exchange of the texts
    windows = seeded.select("row", "id", "text", "lone_seeds").mapInArrow(lambda b: _rows(b, windows_of, ["hash", "more"]), "row long, pos int, hash long, more long")
    if keep_first:
        judged = seeded.join(_judged(windows), "row", "left")
    else:
        judged = seeded.join(_alone(windows, "lone_windows"), "row", "left").withColumn("first_windows", F.lit(None).cast("array<int>"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept, spans = [], [], [], []
            for text, seeds_alone, windows_alone, windows_first in zip(batch["text"], batch["lone_seeds"], batch["lone_windows"], batch["first_windows"], strict=True):
                raw = _raw(text)
                tokens = raw.split()
                again = np.empty(0, np.int64)
                if len(tokens) >= width:
                    again = _candidates(word_hashes(raw), seeds_alone, width, seed)
                    if windows_alone.is_valid:
                        again = again[~np.isin(again, windows_alone.values.to_numpy())]
                runs = []
                if len(again):
                    change = np.zeros(len(tokens) + 1, np.int32)
                    change[again] += 1
                    change[again + width] -= 1
                    covered = np.cumsum(change[:-1]) > 0
                    if windows_first.is_valid:  # their words stay
                        first = windows_first.values.to_numpy()
                        spared = np.zeros(len(tokens) + 1, np.int32)
                        spared[first] += 1
                        spared[first + width] -= 1
                        covered &= np.cumsum(spared[:-1]) == 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).view(np.int8)))
                    runs = [{"start": int(a), "length": int(b - a)} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                    keep = [w for w, c in zip(tokens, covered.tolist(), strict=True) if not c]
                else:
                    keep = tokens
                counts.append(len(tokens))
                removed.append(len(tokens) - len(keep))
                kept.append(b" ".join(keep).decode("utf-8", "surrogatepass"))
                spans.append(runs)
            types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))]
            made = [pa.array(x, t) for x, t in zip((counts, removed, kept, spans), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["id"], *made], ["id", "n_words", "n_removed", "kept", "spans"])

    id_type = texts.schema["id"].dataType.simpleString()
    shape = f"id {id_type}, n_words long, n_removed long, kept string, spans array<struct<start:int,length:int>>"
    return judged.select("id", "text", "lone_seeds", "lone_windows", "first_windows").mapInArrow(cut, shape).withColumnRenamed("id", id_col)
