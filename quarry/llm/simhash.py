"""SimHash near-duplicates with pigeonring filtering.

A document's 64-bit fingerprint is the bitwise majority of the XXH64 (seed 42)
values of its word shingles. Two fingerprints link at ``max_bits`` (tau) or
fewer differing bits; a document's class is its connected component.

Filtering. The 64 bits are cut into m segments on a ring. If two fingerprints
differ in at most tau bits, the pigeonring principle gives a start segment from
which every chain of l consecutive segments differs in at most
floor(l * tau / m) bits. The chains whose budget is 0 must match exactly: with
m = 2 tau + 1 these are the first two segments, which form the join key (m
keys a fingerprint). Keys group the *distinct* fingerprints; the longer chains'
budgets are checked on each pair of a group before the Hamming distance is.

Groups. Identical fingerprints collapse before any join, so copies cost one
row. A key with more than ``GROUP`` fingerprints is split exactly: the third
and fourth segments differ together in at most ``b`` bits, so of any b+2 pieces
of them all but b agree; with b = 1 each key is refined by all pieces but one.
A refined group agrees on all but one piece and the remaining ring, so its
size is bounded by the bits left free, not by the input. Each group yields the
links of a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry.llm.common import byte_words, saved, spread_small
from quarry.llm.components import components

SEED = 42
SLICE = 500  # rows handed on at a time
GROUP = 4096  # distinct fingerprints of one key compared in one task; beyond, the key is refined
PIECES = 13  # of the refined segments


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bits of the shingles' hashes; 0 for a null text or one without a word."""
    words = byte_words(text, lower=True)
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)])
    hashes = np.frombuffer(raw, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded scratch for very long texts
        ones += np.unpackbits(hashes[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, text_col: str = "text", out_col: str = "simhash", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``out_col`` long: the fingerprint's 64 bits (as a signed long).

    ``keep`` names the columns to hand on (default: all); rows stream through
    the tasks ``SLICE`` at a time.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != out_col]
    rows = docs.select(*dict.fromkeys([*kept, text_col]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = np.array([fingerprint(t.as_py(), shingle) for t in part[text_col]], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), pa.array(found)], [*kept, out_col])

    return rows.mapInArrow(run, StructType([*(rows.schema[c] for c in kept), StructField(out_col, LongType())]))


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the 2 tau + 1 ring segments, widths as even as can be."""
    m = 2 * max_bits + 1
    edges = [64 * i // m for i in range(m + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(m)]


def _bits(col, at: int, width: int):
    return F.shiftrightunsigned(col, at).bitwiseAND(F.lit((1 << width) - 1))


def _keys(fps: DataFrame, max_bits: int) -> DataFrame:
    """One row per fingerprint and start segment: ``start``, ``key`` (the two exact segments)."""
    ring, fp = segments(max_bits), F.col("fp")
    chains = []
    for i, (at, width) in enumerate(ring):
        nxt, nxt_width = ring[(i + 1) % len(ring)]
        if max_bits == 0:
            chains.append(F.struct(F.lit(i).alias("start"), fp.alias("key")))
            continue
        chains.append(F.struct(F.lit(i).alias("start"), F.shiftleft(_bits(fp, at, width), nxt_width).bitwiseOR(_bits(fp, nxt, nxt_width)).alias("key")))
    return fps.select("fp", F.explode(F.array(*chains)).alias("k")).select("fp", "k.start", "k.key")


def _refined(keys: DataFrame, max_bits: int) -> DataFrame:
    """Split the keys of a hot group by all but ``budget`` pieces of the next two segments (see the module)."""
    ring = segments(max_bits)
    m = len(ring)
    free = 4 * max_bits // m  # the budget of the chain of four: 1 for every max_bits
    parts = None
    for i in range(m):
        (a, wa), (b, wb) = ring[(i + 2) % m], ring[(i + 3) % m]
        joined = F.shiftleft(_bits(F.col("fp"), a, wa), wb).bitwiseOR(_bits(F.col("fp"), b, wb))
        width = wa + wb
        cuts = [width * p // PIECES for p in range(PIECES + 1)]
        dropped = []
        for p in range(PIECES - free + 1):
            mask = ((1 << width) - 1) ^ (((1 << cuts[p + free]) - 1) ^ ((1 << cuts[p]) - 1))
            dropped.append(F.struct(F.lit(p).alias("piece"), joined.bitwiseAND(F.lit(mask)).alias("rest")))
        parts = F.when(F.col("start") == i, F.array(*dropped)) if parts is None else parts.when(F.col("start") == i, F.array(*dropped))
    return keys.select("fp", "start", "key", F.explode(parts).alias("r")).select("fp", "start", "key", F.col("r.piece").alias("piece"), F.col("r.rest").alias("rest"))


def _forest(start: int, fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning links among a group's fingerprints, each passing the chain budgets and the full distance."""
    ring = segments(max_bits)
    m = len(ring)
    order = [ring[(start + i) % m] for i in range(m)]
    masks, budgets, mask = [], [], 0
    for length, (at, width) in enumerate(order, 1):
        mask |= ((1 << width) - 1) << at
        if 0 < length * max_bits // m or length == m:
            masks.append(np.uint64(mask))
            budgets.append(length * max_bits // m)
    fps = np.unique(fps)
    unseen, links = np.ones(len(fps), bool), []
    for seed in range(len(fps)):
        if not unseen[seed]:
            continue
        unseen[seed] = False
        todo = [seed]
        while todo:  # breadth first over the links of this group
            x = todo.pop()
            rest = np.flatnonzero(unseen)
            if not len(rest):
                break
            differ = fps[rest] ^ fps[x]
            for mask, budget in zip(masks, budgets, strict=True):
                near = np.bitwise_count(differ & mask) <= budget
                rest, differ = rest[near], differ[near]
            unseen[rest] = False
            links += [(int(fps[x]), int(fps[y])) for y in rest]
            todo += rest.tolist()
    return links


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """``src``, ``dst``: links that connect exactly the fingerprints within ``max_bits`` of each other.

    ``fps``: distinct ``fp`` long. Chain links within a group are a spanning
    forest, so a dense group costs as many rows as it has fingerprints.
    """
    keys = _keys(fps, max_bits)
    sizes = keys.groupBy("start", "key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    shared = keys.join(sizes, ["start", "key"])
    groups = shared.where(F.col("n") <= GROUP) if max_bits else shared
    plain = groups.select("fp", "start", "key", F.lit(-1).alias("piece"), F.lit(0).cast("long").alias("rest"))
    if max_bits:
        plain = plain.unionByName(_refined(shared.where(F.col("n") > GROUP), max_bits))
    groups = plain.groupBy("start", "key", "piece", "rest").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for start, group in zip(batch["start"].to_pylist(), batch["fps"], strict=True):
                found += _forest(start, group.values.to_numpy().view(np.uint64), max_bits)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["src", "dst"])

    return groups.select("start", "fps").mapInArrow(verify, "src long, dst long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: ``id_col``, ``simhash`` long and ``component_id``, the smallest id reachable over links.

    Null ids: such a row links others as any row does, but is not counted for
    ``component_id`` (null if its whole component has no id). A null or empty
    text has fingerprint 0 and links like any other. Repeated rows repeat. An
    empty table gives an empty one. Other columns are ignored.
    """
    return _classes(docs, shingle, max_bits, text_col, id_col).select(F.col("id").alias(id_col), F.col("fp").alias("simhash"), "component_id")


def _classes(docs: DataFrame, shingle: int, max_bits: int, text_col: str, id_col: str) -> DataFrame:
    """Per row: ``id``, ``fp``, ``root`` (names its component, also where two have one least id) and ``component_id``."""
    rows = saved(fingerprints(spread_small(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))), shingle, "text", "fp", keep=["id"]), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    found = components(links(classes.select("fp"), max_bits))
    labelled = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    best = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    members = labelled.select("fp", "root").join(best, "root").select("fp", "root", "component_id")
    return rows.join(members, "fp").select("id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component: the row of its smallest id.

    Where rows of different texts share that id, the component's own row stays
    (of the least fingerprint, if several are in it), so an id that heads two
    components stays twice. Repeated rows count once. Where a component has no
    id at all, one row of each of its fingerprints stays.
    """
    classes = saved(_classes(docs, shingle, max_bits, text_col, id_col), "classes")
    heads = classes.where(F.col("id") == F.col("component_id")).groupBy("root", "id").agg(F.min("fp").alias("fp")).select("id", "fp")
    unlike = classes.groupBy("id").agg((F.min("fp") != F.max("fp")).alias("unlike")).where("unlike")  # ids of rows of different texts
    unlike = heads.join(unlike.select("id"), "id", "left_semi").select(F.col("id").alias(id_col), F.col("fp").alias("__fp"))
    plain = heads.select(F.col("id").alias(id_col))
    if unlike.isEmpty():
        named = docs.join(plain, id_col, "left_semi").dropDuplicates([id_col])
    else:  # only these need their fingerprints again
        named = docs.join(plain.join(unlike, id_col, "left_anti"), id_col, "left_semi").dropDuplicates([id_col])
        twofold = fingerprints(docs.join(unlike.select(id_col).distinct(), id_col, "left_semi"), shingle, text_col, "__fp")
        named = named.select(*docs.columns).unionByName(twofold.join(unlike, [id_col, "__fp"], "left_semi").dropDuplicates([id_col, "__fp"]).select(*docs.columns))
    without = classes.where(F.col("component_id").isNull()).select(F.col("fp").alias("__lone")).distinct()
    bare = fingerprints(docs.where(F.col(id_col).isNull()), shingle, text_col, "__fp")
    bare = bare.join(without, F.col("__fp") == F.col("__lone"), "left_semi").dropDuplicates(["__fp"]).drop("__fp")
    return named.select(*docs.columns).unionByName(bare)
