"""Distributed word count over text lines, entirely in the JVM.

split + explode + trim + a hash aggregate with map-side combine: a very
frequent word is pre-counted in every task, so it never concentrates rows in
one reducer; the output is vocabulary-sized and stays distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.words import TRIM_CHARACTERS, WHITESPACE_PATTERN, split_words
from quarry.plans.parallelism import spread


def words(
    lines: DataFrame,
    text: str = "text",
    pattern: str = WHITESPACE_PATTERN,
    trim_characters: str = TRIM_CHARACTERS,
    min_partitions: int | None = None,
) -> DataFrame:
    """One row per normalised, non-empty word (column ``word``).

    Each word is lower-cased and then trimmed. Lower-casing the whole line
    once gives the same words as lower-casing each token (no character
    lower-cases into or out of whitespace) at a fraction of the calls.
    """
    source = spread(lines.select(text), min_partitions)
    tokens = source.select(F.explode(split_words(F.lower(F.col(text)), pattern)).alias("token"))
    return tokens.select(F.btrim(F.col("token"), F.lit(trim_characters)).alias("word")).where(F.col("word") != "")


def word_count(
    lines: DataFrame,
    text: str = "text",
    pattern: str = WHITESPACE_PATTERN,
    trim_characters: str = TRIM_CHARACTERS,
    sort: bool = True,
    min_partitions: int | None = None,
) -> DataFrame:
    """word, count (bigint), in code-point order of ``word``."""
    counts = (
        words(lines, text, pattern, trim_characters, min_partitions)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return counts.orderBy("word") if sort else counts
