"""URL filters: a blocked Bloom filter in front of an exact hash join.

A list of canonical URL rules (host and path start, allow or block) judges
URLs. Every URL yields the candidate keys it could be listed under (each domain
suffix of its host, each path start of a listed length). Candidates are tested
against a blocked Bloom filter of the listed keys; only possible hits reach the
hash join against the list itself, which removes false positives. The longest
listed key wins; without one the verdict is ``allow``.

The filter is built by Spark: listed keys are hashed to a block of 256 bits (four
longs), ORed per block. Its size follows the number of rules and is capped at
``MAX_BLOCKS`` blocks (32 MB), the bound under which it is broadcast; a fuller
filter passes more candidates on to the join and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import lower_az

BLOCK_BITS = 256
PROBES = 8  # bits set per key, all in one block
KEYS_PER_BLOCK = 16
MAX_BLOCKS = 1 << 20
ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty if null or no ``://``."""
    return F.coalesce(lower_az(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or end; empty if null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block number and the bit positions within the block of a key."""
    first, second = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    bits = [F.shiftrightunsigned(second, 8 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(PROBES)]
    return F.pmod(first, F.lit(blocks)), bits


def bloom_filter(keys: DataFrame, key_col: str = "key") -> tuple[int, np.ndarray]:
    """The number of blocks and their bits: an array of blocks x 4 unsigned longs."""
    listed = keys.count()
    blocks = int(min(MAX_BLOCKS, max(1, -(-listed // KEYS_PER_BLOCK))))
    block, bits = _place(F.col(key_col), blocks)
    one = F.lit(1).cast("long")
    words = []
    for w in range(BLOCK_BITS // 64):
        word = F.lit(0).cast("long")
        for b in bits:
            shifted = F.call_function("shiftleft", one, b.bitwiseAND(F.lit(63)))
            word = word.bitwiseOR(F.when(F.shiftright(b, 6) == w, shifted).otherwise(F.lit(0).cast("long")))
        words.append(F.bit_or(word).alias(f"w{w}"))
    table = keys.select(F.col(key_col)).groupBy(block.alias("block")).agg(*words).toPandas()  # at most MAX_BLOCKS rows of 40 bytes
    out = np.zeros((blocks, BLOCK_BITS // 64), np.uint64)
    for w in range(BLOCK_BITS // 64):
        out[table["block"].to_numpy(np.int64), w] = table[f"w{w}"].to_numpy(np.int64).view(np.uint64)
    return blocks, out


def _possible(shipped):
    """Vectorised probe: are all bits of a key set in its block?"""

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        table = shipped.value
        for block, second in batches:
            blocks = block.to_numpy(zero_copy_only=False)
            seeds = second.to_numpy(zero_copy_only=False).view(np.uint64)
            hit = np.ones(len(blocks), bool)
            for i in range(PROBES):
                bit = (seeds >> np.uint64(8 * i)) & np.uint64(BLOCK_BITS - 1)
                hit &= (table[blocks, (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
            yield pa.array(hit)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "boolean")


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (host and path start as one string; null if none fits) and ``verdict``.

    ``rules``: ``host``, ``path`` (start; never null), ``action`` (``allow`` or
    ``block``). A rule fits its host and all subdomains if the URL's path
    starts with the rule's path. The longest fitting rule wins; the same rule
    listed with both actions blocks. A null URL, or one without ``://``, has an
    empty host and path and fits no rule of a host. Repeated rows repeat;
    columns already named like an output are replaced.
    """
    spark = pages.sparkSession
    listed = rules.select((F.col("host")).alias("h"), F.col("path").alias("p"), "action").where(F.col("h").isNotNull() & F.col("p").isNotNull())
    listed = listed.groupBy("h", "p").agg(F.max(F.col("action")).alias("action"))  # block sorts after allow
    listed = listed.withColumn("key", F.concat_ws("\n", "h", "p"))
    lengths = sorted(int(r[0]) for r in listed.select(F.length("p")).distinct().collect())  # no more than the longest listed path has characters
    blocks, table = bloom_filter(listed)
    shipped = spark.sparkContext.broadcast(table)  # at most MAX_BLOCKS x 32 bytes

    urls = pages.select(F.col(url_col).alias("u")).distinct()
    urls = urls.select("u", host_of(F.col("u")).alias("h"), path_of(F.col("u")).alias("p"))
    labels = F.split("h", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.transform(F.filter(F.array(*[F.lit(x) for x in lengths]).cast("array<int>"), lambda n: n <= F.length("p")), lambda n: F.substring(F.col("p"), F.lit(1), n))
    tried = urls.select("u", F.explode(hosts).alias("rh"), F.col("p")).select("u", "rh", F.explode(starts).alias("rp"))
    tried = tried.select("u", F.concat_ws("\n", "rh", "rp").alias("key"))
    block, _ = _place(F.col("key"), blocks)
    hits = tried.where(_possible(shipped)(block, F.xxhash64("key", F.lit(1))))
    found = hits.join(listed.select("key", "h", "p", "action").hint("shuffle_hash"), "key")
    rule = F.concat("h", "p")
    best = found.groupBy("u").agg(F.max_by(F.struct(rule.alias("rule"), F.col("action").alias("verdict")), F.struct(F.length(rule), rule)).alias("best"))
    out = pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    best = best.select(F.col("u").alias("__url"), F.col("best.rule").alias("__rule"), F.col("best.verdict").alias("__verdict"))
    out = out.join(best, F.col(url_col) == F.col("__url"), "left")
    return out.withColumns({"rule": F.col("__rule"), "verdict": F.coalesce("__verdict", F.lit(ALLOW))}).drop("__url", "__rule", "__verdict")
