"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as lower-case letters and digits with every other run as one
space. An item of m characters may differ by k = floor(error_rate * m) edits.
It is split into k + 1 pieces, so any occurrence within k edits holds at least
one piece unchanged. All items' pieces go into one matcher that reads each
whole document once; around a piece hit, the only place where the item can lie
is searched with Myers' bit-parallel edit distance.

Items of less than ``LEAST_CHARS`` characters say little: such an item is found
only where it stands unchanged as whole words.

The items are the small side: they travel to the tasks in blocks of at most
``BLOCK_CHARS`` characters, each one pass over the documents, so no broadcast
grows with the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.points import as_text, folded

ERROR_RATE = 0.08  # edits allowed per character of an item
LEAST_CHARS = 24  # of an item that is matched with edits and inside words
BLOCK_CHARS = 8_000_000  # characters of items matched in one pass


def normal(text: str | None) -> str:
    """The compared form of a text; empty if it has no letter or digit."""
    return as_text(folded(text, "isalnum")).strip(" ")


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """Offset and text of edits + 1 pieces, lengths as even as can be."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, peq: dict[str, int], text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of ``pattern`` to any substring of ``text`` and the first end reaching it; None beyond ``most``."""
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, most + 1, -1
    for i, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best, end = score, i
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv
    return (best, end) if best <= most else None


class ItemMatcher:
    """Pieces of all items in one matcher, and their verification."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items = []
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for number, text in items:
            edits = int(error_rate * len(text)) if len(text) >= LEAST_CHARS else 0
            peq: dict[str, int] = {}
            for i, c in enumerate(text):
                peq[c] = peq.get(c, 0) | (1 << i)
            for offset, piece in pieces(text, edits):
                by_piece.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((number, text, edits, peq))
        self.finder = ahocorasick.Automaton()
        for piece, uses in by_piece.items():
            self.finder.add_word(piece, (len(piece), uses))
        if by_piece:
            self.finder.make_automaton()
        self.some = bool(by_piece)

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item, least distance, end of that occurrence in ``text``) of every item found."""
        places: dict[int, set[int]] = {}
        if self.some:
            for last, (length, uses) in self.finder.iter(text):
                for at, offset in uses:
                    # starts less than edits + 1 apart share one search window
                    places.setdefault(at, set()).add((last + 1 - length - offset) // (self.items[at][2] + 1))
        found = []
        for at, windows in places.items():
            number, item, edits, peq = self.items[at]
            exact = text.find(item) if len(item) >= LEAST_CHARS else f" {text} ".find(f" {item} ")
            if exact >= 0:
                found.append((number, 0, exact + len(item)))
                continue
            if len(item) < LEAST_CHARS:
                continue
            best = None
            for w in sorted(windows):
                start = max(0, w * (edits + 1) - edits)
                stop = (w + 1) * (edits + 1) + len(item) + edits
                hit = myers(item, peq, text[start:stop], edits if best is None else best[0] - 1)
                if hit:
                    best = (hit[0], start + hit[1])
            if best:
                found.append((number, *best))
        return found


def matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per input row and benchmark item found in it: ``id_col``, ``item_col`` (long), ``distance``, ``end``.

    ``distance`` is the least edit distance, ``end`` where that occurrence ends
    in the compared form. Items shorter than ``LEAST_CHARS`` there are found as
    whole words without edits. Items without a letter or digit, or with a null id or
    text, match nothing; null and empty documents hold nothing. Repeated
    documents and items repeat their rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    wanted = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).where(F.col("item").isNotNull() & F.col("text").isNotNull())
    total = wanted.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // (BLOCK_CHARS // 2)))
    shape = f"id {docs.select(id_col).schema[0].dataType.simpleString()}, item long, distance int, end int"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = None
    for block in range(blocks):
        mine = wanted.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else wanted
        texts = [(r["item"], normal(r["text"])) for r in mine.toLocalIterator()]  # about half of BLOCK_CHARS
        shipped = spark.sparkContext.broadcast(sorted((i, t) for i, t in texts if t))

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            matcher = ItemMatcher(shipped.value, error_rate)
            for batch in batches:
                places, found = [], []
                for i, text in enumerate(batch["text"]):
                    hits = matcher.find(normal(text.as_py()))
                    places += [i] * len(hits)
                    found += hits
                ids = batch["id"].take(pa.array(places, pa.int32()))
                columns = [pa.array([h[c] for h in found], kind) for c, kind in enumerate((pa.int64(), pa.int32(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([ids, *columns], ["id", "item", "distance", "end"])

        part = rows.mapInArrow(run, shape)
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "distance", "end")


def uncontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found (rows with a null id are judged by their own text)."""
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    judged = docs.withColumn("__key", F.to_json(key))
    leaks = matches(judged, benchmark, text_col=text_col, id_col="__key", **options).select("__key").distinct()
    return judged.join(leaks, "__key", "left_anti").drop("__key")
