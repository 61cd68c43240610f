"""The corpus pipeline: language ID, near-dedup, substring dedup, decontamination, tokenisation.

Each stage takes ``(spark, docs, sf_dir)`` with ``docs`` in the columns of
``documents`` and returns a DataFrame; it is written as Parquet and read again as
the next stage's ``docs``. All stages but the last return those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, contamination, langid, simhash, substrings
from quarry.llm.common import saved, spread_small, table
from quarry.llm.queries import importable, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE, MAX_BITS = 3, 2  # of the near-duplicate stage
MIN_REPEAT_WORDS = 50  # of the substring stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: ``und`` and calibrated rejections go.

    Learned from the labelled rows of ``docs``. Rows without a letter (null and
    empty texts among them) go; repeated rows are judged alike.
    """
    importable(spark)
    return langid.recognised(spread_small(docs.select(*COLUMNS)), langid.fit(docs, F.lit(True)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one of the smallest ``doc_id`` (see ``simhash.keep_one``)."""
    importable(spark)
    return simhash.keep_one(docs.select(*COLUMNS), SHINGLE, MAX_BITS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str, keep_first: bool = True) -> DataFrame:
    """Passages of ``MIN_REPEAT_WORDS`` or more words that occur again are cut wherever they occur but first.

    The first occurrence stays (see ``substrings.repeats``), so no passage is
    lost; without ``keep_first`` it goes as well. A document that loses words
    keeps the others joined by one space, and its ``n_chars`` follows; one that
    loses all of them goes. Others, those without a word among them, stay as
    they are. Repeated rows repeat each other.
    """
    importable(spark)
    numbered = docs.select(*COLUMNS).withColumn("__row", F.col("doc_id"))
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("doc_id").isNull())
    if not repeated.isEmpty():  # ids do not name rows: number them in a written table
        numbered = saved(docs.select(*COLUMNS).withColumn("__row", F.monotonically_increasing_id()), "rows")
    found = substrings.repeats(numbered, MIN_REPEAT_WORDS, text_col="text", id_col="__row", keep_first=keep_first)
    cut = found.where(F.col("n_removed") > 0).select("__row", "kept", (F.col("n_removed") == F.col("n_words")).alias("gone"))
    joined = numbered.join(cut, "__row", "left").where(F.coalesce(~F.col("gone"), F.lit(True)))
    return joined.withColumns({"text": F.coalesce("kept", "text"), "n_chars": F.when(F.col("kept").isNotNull(), F.length("kept").cast("long")).otherwise(F.col("n_chars"))}).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    importable(spark)
    return contamination.uncontaminated(spread_small(docs.select(*COLUMNS)), table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoded text.

    Returns ``doc_id``, ``lang``, ``source``, ``n_tokens``, ``ids``, ``decoded``.
    """
    importable(spark)
    rows = spread_small(docs.select("doc_id", "text", "lang", "source"))
    done = bpe.encode(rows, tokenizer_path(), decoded_col="decoded", keep=["doc_id", "lang", "source"])
    return done.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", decontaminate),
    ("BPE encoding and decoding", tokenize),
]

#: SQL cannot express the language models or the tokenisation automaton: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-").lower())
    return docs
