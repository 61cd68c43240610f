"""Language-model scoring by prediction by partial matching (PPM).

The model is a byte-context trie: for every context of 0..K symbols the counts
of the symbols seen after it. A symbol is coded in the longest context that
has seen it; each context that has not costs an escape (method C: d / (n + d)
for d distinct symbols among n), and the symbols of a context escaped from are
excluded from the shorter ones. Below order 0 the symbols left are uniform.
The trie is pretrained on the training rows; a text's score is the log10
probability of its lower-cased words, joined by one space, and an end symbol.

Sets of symbols nest (whatever follows a context follows its suffixes), so
exclusion is a subtraction: each context stores its n, d and the count its
symbols have in the next shorter context, and any symbol's probability needs a
few lookups. A symbol seen in its longest context needs one.

Spark counts the longest contexts' grams and the words of all training rows
(partial sums in each task, then one shuffle) and makes each level of the trie,
a written table, from the level of the next longer contexts by two windows of at
most 258 rows a group. One pass over the texts, whatever the size of the model,
looks up the most frequent grams (``HEAD_GRAMS`` at most) and words
(``HEAD_WORDS`` at most) in the tasks; a text's other grams and words, each once
with its count, meet their log probabilities in a join. Grams that the training
rows do not hold are escaped once each, however many texts have them, by joins
with the levels from the longest to the shortest. So nothing that grows with the
corpus is broadcast or passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import LOWER_AZ, numbered, saved
from quarry.llm.hashes import SortedHashes
from quarry.llm.words import word_hashes

ORDER = 5
END, BEFORE, SYMBOLS = 256, 257, 257  # END is coded, BEFORE only stands in contexts
WIDTH = np.uint64(9)  # bits of a symbol
MOST_ORDER = 6  # seven symbols of nine bits fit a long
HEAD_GRAMS = 1 << 22
HEAD_WORDS = 1 << 17
CHUNK = 1 << 19  # symbols handled at a time: scratch of some 50 MB


def tokens(text: str | None) -> bytes:
    """The scored form of a text: words in lower case (A-Z), joined by one space."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(LOWER_AZ).split())


def _stream(text: bytes, order: int) -> np.ndarray:
    out = np.empty(order + len(text) + 1, np.uint16)
    out[:order] = BEFORE
    out[order:-1] = np.frombuffer(text, np.uint8)
    out[-1] = END
    return out


def grams(stream: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed (context, symbol) of every coded place of a stream of texts, and the places."""
    wide = stream.astype(np.uint64)
    n = len(wide) - order
    keys = np.zeros(max(0, n), np.uint64)
    for i in range(order + 1):
        keys = (keys << WIDTH) | wide[i : i + n]
    places = np.flatnonzero(stream[order:] != BEFORE)
    return keys[places], places


def chunks(texts: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Packed grams and the index of the text of each, about ``CHUNK`` at a time; long texts come in pieces."""
    parts, owners, size = [], [], 0

    def out() -> tuple[np.ndarray, np.ndarray]:
        stream = np.concatenate(parts)
        owner = np.repeat(np.array(owners, np.int32), [len(p) for p in parts])
        keys, places = grams(stream, order)
        return keys, owner[places + order]

    for i, text in enumerate(texts):
        stream = _stream(text, order)
        if len(stream) <= CHUNK:
            parts.append(stream)
            owners.append(i)
            size += len(stream)
            if size >= CHUNK:
                yield out()
                parts, owners, size = [], [], 0
        else:
            for at in range(order, len(stream), CHUNK):  # each piece with its context before it
                keys, _ = grams(stream[at - order : at + CHUNK], order)
                yield keys, np.full(len(keys), i, np.int32)
    if parts:
        yield out()


def _count(train: DataFrame, order: int) -> DataFrame:
    """``kind`` (0 gram, 1 word), ``key``, ``n`` over the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(kind: int, keys: np.ndarray) -> pa.RecordBatch:
            distinct, n = np.unique(keys, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int8)), pa.array(distinct.view(np.int64)), pa.array(n.astype(np.int64))], ["kind", "key", "n"])

        for batch in batches:
            texts = [tokens(t.as_py()) for t in batch["text"]]
            for keys, _ in chunks(texts, order):
                yield made(0, keys)
            waiting, size = [], 0
            for text in texts:
                if text:
                    waiting.append(word_hashes(text))
                    size += len(waiting[-1])
                if size >= CHUNK:
                    yield made(1, np.concatenate(waiting))
                    waiting, size = [], 0
            if waiting:
                yield made(1, np.concatenate(waiting))

    return train.select("text").mapInArrow(run, "kind byte, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _suffix(symbols: int) -> Column:
    """The last ``symbols`` symbols of a packed gram."""
    return F.col("key").bitwiseAND(F.lit((1 << (int(WIDTH) * symbols)) - 1))


def _context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, int(WIDTH))


def _levels(grams: DataFrame, order: int) -> dict[int, DataFrame]:
    """The trie's level of every order, made from ``key``, ``c`` of the longest grams.

    Per gram: its count ``c``; ``n``, ``d`` and ``below`` of its context (symbols,
    distinct ones, and what these count in the next shorter context). ``first``
    marks one gram of every context. A group of either window differs in one symbol.
    """
    levels = {}
    for o in range(order, -1, -1):
        ending, context = Window.partitionBy(_suffix(o)), Window.partitionBy(_context(F.col("key")))
        parent = F.sum("c").over(ending) if o else F.lit(0).cast("long")
        leads = F.col("key") == F.min("key").over(ending) if o else F.lit(False)
        linked = grams.select("key", "c", parent.alias("parent"), leads.alias("leads"))
        levels[o] = saved(
            linked.select(
                "*",
                F.sum("c").over(context).alias("n"),
                F.count("*").over(context).alias("d"),
                F.sum("parent").over(context).alias("below"),
                (F.col("key") == F.min("key").over(context)).alias("first"),
            ),
            f"lm-order-{o}",
        )
        grams = levels[o].where("leads").select(_suffix(o).alias("key"), F.col("parent").alias("c"))
    return levels


def _escaped(missing: DataFrame, levels: dict[int, DataFrame], order: int) -> DataFrame:
    """``key``, ``log``: distinct grams that their longest context has not seen, escaped down the orders."""
    left = missing.select("key", F.lit(0.0).alias("log"), F.lit(0).cast("long").alias("gone_n"), F.lit(0).cast("long").alias("gone_d"), F.lit(False).alias("done"))
    for o in range(order, -1, -1):
        contexts = levels[o].where("first").select(_context(F.col("key")).alias("context"), "n", "d", "below")
        left = left.join(contexts, _context(_suffix(o + 1)) == F.col("context"), "left")
        if o < order:
            left = left.join(levels[o].select(F.col("key").alias("gram"), "c"), _suffix(o + 1) == F.col("gram"), "left")
        else:
            left = left.withColumn("c", F.lit(None).cast("long"))
        known, coded = F.col("context").isNotNull(), F.col("c").isNotNull()
        n, d = (F.coalesce(x, F.lit(0)) - gone for x, gone in ((F.col("n"), F.col("gone_n")), (F.col("d"), F.col("gone_d"))))
        step = F.when(coded, F.log10(F.col("c") / (n + d))).when(d > 0, F.log10(d / (n + d))).otherwise(0.0)
        gone_d = F.when(known, F.col("d")).otherwise(F.col("gone_d"))
        if o == 0:
            step -= F.when(coded, 0.0).otherwise(F.log10(F.greatest(F.lit(1), F.lit(SYMBOLS) - gone_d)))
        left = left.select(
            "key",
            (F.col("log") + F.when(F.col("done"), 0.0).otherwise(step)).alias("log"),
            F.when(known, F.col("below")).otherwise(F.col("gone_n")).alias("gone_n"),
            gone_d.alias("gone_d"),
            (F.col("done") | coded).alias("done"),
        )
    return left.select("key", "log")


def _head_count(table: DataFrame, count: str, most: int) -> int:
    """The least power of two such that no more than ``most`` rows have a ``count`` that high."""
    power = F.length(F.bin(count)) - 1
    sizes = {r["p"]: r["m"] for r in table.groupBy(power.alias("p")).agg(F.count("*").alias("m")).collect()}  # 63 rows at most
    held = 0
    for p in range(max(sizes, default=0) + 1, -1, -1):
        held += sizes.get(p, 0)
        if held > most:
            return 1 << (p + 1)
    return 1


def _arrays(head: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ``key`` and ``log`` columns of a bounded table."""
    got = head.select("key", "log").toArrow().combine_chunks()
    return got["key"].to_numpy().view(np.uint64), got["log"].to_numpy()


def score(docs: DataFrame, train: Column, order: int = ORDER, head_grams: int = HEAD_GRAMS, head_words: int = HEAD_WORDS, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Score every whole text with a model of the rows where ``train`` holds.

    Returns per input row: ``id_col``, ``n_tokens`` (words and one end),
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score``
    (add-one unigram log10 probability of the tokens) and ``score`` (PPM log10
    probability). A null or empty text is just its end. Null and repeated ids
    and repeated rows are scored row by row; with no training rows the model is
    uniform. Other columns are ignored. ``order`` is 0 to 6; ``head_grams`` and
    ``head_words`` bound what is broadcast and change no result.
    """
    if not 0 <= order <= MOST_ORDER:
        raise ValueError(f"order must be 0 to {MOST_ORDER}, not {order}")
    spark = docs.sparkSession
    texts = numbered(docs.withColumn("__train", F.coalesce(train, F.lit(False))), id_col, text_col, "__train")
    trained = texts.where("__train").select("text")
    counts = saved(_count(trained, order), "lm-counts")
    ends = trained.count()
    words = counts.where("kind = 1")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = int(total) + ends, int(distinct) + (ends > 0)
    spread = float(np.log10(total + distinct + 1))  # log10 of N + 1 * (V + 1)
    levels = _levels(counts.where("kind = 0").select("key", F.col("n").alias("c")), order)

    grams = levels[order].select("key", "c", F.log10(F.col("c") / (F.col("n") + F.col("d"))).alias("log"))
    words = words.select("key", F.col("n").alias("c"), F.log10(F.col("n") + 1.0).alias("log"))
    gram_least, word_least = _head_count(grams, "c", head_grams), _head_count(words, "c", head_words)
    heads = _arrays(grams.where(F.col("c") >= gram_least)), _arrays(words.where(F.col("c") >= word_least))  # at most ``head_grams`` and ``head_words`` rows
    told = saved(_one_pass(texts, spark.sparkContext.broadcast(heads), order), "lm-told")

    rare = grams.where(F.col("c") < gram_least)
    missing = told.where("kind = 0 AND NOT learned").select("key").distinct().join(rare, "key", "left_anti")  # training rows miss none
    tail = words.where(F.col("c") < word_least).select(F.lit(1).alias("k"), F.col("key").alias("w"), "log")
    for some in (rare, _escaped(missing, levels, order)):
        tail = tail.unionByName(some.select(F.lit(0).alias("k"), F.col("key").alias("w"), "log"))
    looked = told.join(tail, (F.col("kind") == F.col("k")) & (F.col("key") == F.col("w")), "left")
    found = F.coalesce(F.col("n") * F.col("log"), F.lit(0.0))
    word = (F.col("kind") == 1) & F.col("k").isNotNull()
    summed = looked.groupBy("row").agg(
        (F.sum("score") + F.sum(F.when(F.col("kind") == 0, found).otherwise(0.0))).alias("score"),
        (F.sum("head_log") + F.sum(F.when(word, found).otherwise(0.0))).alias("known_log"),
        F.sum("n_tokens").alias("n_tokens"),
        (F.sum("head_known") + F.sum(F.when(word, F.col("n")).otherwise(0))).alias("n_known"),
    )
    end_log, end_known = float(np.log10(ends + 1)), int(ends > 0)
    done = texts.select("row", "id").join(summed, "row")
    return done.select(
        F.col("id").alias(id_col),
        (F.col("n_tokens") + 1).alias("n_tokens"),
        (F.col("n_known") + end_known).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("known_log") + end_log - (F.col("n_tokens") + 1) * spread).alias("base_score"),
        "score",
    )


class Head:
    """Log probabilities of the most frequent keys, looked up in the tasks."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray):
        self.found = SortedHashes(keys)
        self.logs = np.append(logs[self.found.order], 0.0)  # an absent key's row is -1
        self.found.order = None

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every key, its log probability (0 if absent) and whether it is absent."""
        rows = self.found.rows(keys)
        return self.logs[rows], rows < 0


_heads: dict[int, tuple[Head, Head]] = {}  # the last heads of a worker process


def _tallied(owner: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of owner and key, and how often each occurs."""
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    starts = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])])) if len(keys) else np.empty(0, np.int64)
    return owner[starts], keys[starts], np.diff(np.append(starts, len(keys)))


def _one_pass(texts: DataFrame, shipped, order: int) -> DataFrame:
    """Per text a summary row (kind -1), and a row per distinct gram (kind 0) and word (kind 1) outside the heads.

    ``learned`` tells whether a row's text is a training row.
    """
    stamp = shipped._jbroadcast.id()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if stamp not in _heads:
            _heads.clear()
            _heads[stamp] = tuple(Head(*arrays) for arrays in shipped.value)
        gram_head, word_head = _heads[stamp]

        def made(kind, rows, learned, keys, n=0, scores=0.0, logs=0.0, n_tokens=0, known=0) -> pa.RecordBatch:
            kinds = np.full(len(rows), kind, np.int8)
            numbers = [(rows, np.int64), (keys, np.int64), (n, np.int64), (scores, np.float64), (logs, np.float64), (n_tokens, np.int64), (known, np.int64)]
            arrays = [pa.array(np.broadcast_to(np.asarray(x, t), len(rows))) for x, t in numbers]
            return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(learned), *arrays], ["kind", "learned", "row", "key", "n", "score", "head_log", "n_tokens", "head_known"])

        for batch in batches:
            rows = batch["row"].to_numpy()
            learned = batch["learned"].to_numpy(zero_copy_only=False).astype(bool)
            data = [tokens(t.as_py()) for t in batch["text"]]
            scores = np.zeros(len(rows))
            for keys, owner in chunks(data, order):
                logs, absent = gram_head.look(keys)
                scores += np.bincount(owner, logs, len(rows))
                owner, keys, n = _tallied(owner[absent], keys[absent])
                if len(n):
                    yield made(0, rows[owner], learned[owner], keys.view(np.int64), n)
            logs, sizes, known = np.zeros(len(rows)), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            tail, size = [], 0
            for i, text in enumerate(data):
                hashes = word_hashes(text) if text else np.empty(0, np.uint64)
                found, absent = word_head.look(hashes)
                sizes[i], logs[i], known[i] = len(hashes), found.sum(), (~absent).sum()
                distinct, n = np.unique(hashes[absent], return_counts=True)
                tail.append((np.full(len(n), i), distinct, n))
                size += len(n)
                if size >= CHUNK // 4 or (size and i == len(data) - 1):
                    owner, distinct, n = (np.concatenate(x) for x in zip(*tail, strict=True))
                    yield made(1, rows[owner], learned[owner], distinct.view(np.int64), n)
                    tail, size = [], 0
            # the summary rows' key only spreads them over the join's tasks
            yield made(-1, rows, learned, rows, 0, scores, logs, sizes, known)

    given = texts.select("row", "text", F.col("__train").alias("learned"))
    return given.mapInArrow(run, "kind byte, learned boolean, row long, key long, n long, score double, head_log double, n_tokens long, head_known long")
