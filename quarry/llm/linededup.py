"""Line dedup over levelled sorted runs of line hashes, in DataFrame functions throughout.

Documents come in batches of ascending id. The hashes of lines met so far lie
in runs: tables bucketed and sorted by hash. A batch's own hashes, one row
each, are merge-anti-joined with every run, bucket by bucket where the runs
lie; what is new becomes a run of its own. When a level holds ``fanout`` runs,
they are compacted into one of the next level, so a hash is rewritten once a
level and a batch meets less than ``fanout`` runs a level.

A line of a batch stays if the batch's new run names its document as the first
with that line; an anti-join by hash and document tells the others. A line that
a third of all documents share is one row a task and batch on the way to the
runs, and rows with different documents on the way back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import lower_az, numbered, saved
from quarry.plans.storage import release, saved_buckets, scratch_path

# The white space stripped at both ends of a line.
SPACES = " \t\n\x0b\x0c\r"
MIN_CHARS = 10
BATCHES = 8
FANOUT = 4


def key_of(line: Column) -> Column:
    """A line as it is compared: stripped of ASCII white space, A-Z in lower case."""
    return lower_az(F.btrim(line, F.lit(SPACES)))


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


class LineRuns:
    """Sorted runs of line hashes by level; level i + 1 takes ``fanout`` runs of level i.

    ``levels`` lists each level's runs, tables of ``line`` (hash) and ``doc``
    (the first document that held it).
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("a level needs at least two runs to compact")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch's ``line`` and ``doc`` (any number of rows a line): its lines that no run holds, with their first document.

        The table returned is the batch's run; it stays readable until
        :meth:`compact` has taken it up.
        """
        new = lines.groupBy("line").agg(F.min("doc").alias("doc"))
        for run in self.runs():
            new = new.join(run.select("line").hint("merge"), "line", "left_anti")
        run = saved_buckets(new, "line-run", "line", self.buckets)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(run)
        return run

    def compact(self) -> None:
        """Merge every level that is full into one run of the next; runs hold disjoint lines."""
        at = 0
        while at < len(self.levels):
            full = self.levels[at]
            if len(full) >= self.fanout:
                merged = saved_buckets(reduce(DataFrame.unionByName, full).repartition(self.buckets, "line"), "line-run", "line", self.buckets)
                if at + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[at + 1].append(merged)
                self.levels[at] = []
                release(*full)
            at += 1

    def release(self) -> None:
        release(*self.runs())
        self.levels = []


def _batch_of(doc: Column, cuts: list[int]) -> Column:
    """Number of the batch of a document: batches are ranges of ids."""
    return F.lit(0) + sum(((doc > cut).cast("int") for cut in cuts), F.lit(0))


def drop_repeated_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """Drop the lines that an earlier document holds.

    Lines are split at ``\\n`` and compared by :func:`key_of`; those of
    ``min_chars`` code points or more that stand in several documents stay in
    the one of the smallest id only, there each time they occur. Returns per
    input row: ``id_col``, ``n_lines`` (before dropping; a null or empty text is
    one empty line), ``n_dropped`` and ``kept`` (the lines that stay, joined by
    ``\\n``; empty if none does).

    Ids must be integers. Rows of one id are one document, and so are rows
    without an id, which come last. Other columns are ignored, an empty table
    gives no rows. ``batches`` and ``fanout`` change the work, never the rows.
    Lines are told apart by 128-bit MD5 digests of their keys.
    """
    if docs.schema[id_col].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"{id_col} must be an integer column")
    spark = docs.sparkSession
    texts = numbered(docs, id_col, text_col).select("row", F.col("id").cast("long").alias("id"), "text")
    doc = F.coalesce("id", F.lit((1 << 63) - 1))  # no id: last
    shares = [i / batches for i in range(1, batches)]
    cuts = (texts.agg(F.percentile_approx(doc, shares, 10_000)).first()[0] or []) if shares else []

    # every long line once, with its place; the texts themselves are left behind
    lines = texts.select("row", doc.alias("doc"), F.posexplode(lines_of(F.col("text"))).alias("pos", "raw"))
    lines = lines.select("row", "doc", "pos", key_of(F.col("raw")).alias("key")).where(F.length("key") >= min_chars)
    lines = lines.select("row", "doc", "pos", F.unhex(F.md5(F.col("key").cast("binary"))).alias("line"), _batch_of(F.col("doc"), sorted(set(cuts))).alias("batch"))
    path = scratch_path(spark, "lines")
    lines.write.partitionBy("batch").parquet(path)
    written = spark.read.schema("row long, doc long, pos int, line binary, batch int").parquet(path)

    runs, dropped = LineRuns(spark, fanout=fanout), []
    for batch in range(len(set(cuts)) + 1):
        mine = written.where(F.col("batch") == batch)
        new = runs.add(mine)
        repeated = mine.join(new, ["line", "doc"], "left_anti")
        dropped.append(saved(repeated.select("row", "pos"), "dropped-lines"))
        runs.compact()
    runs.release()
    release(written)
    gone = reduce(DataFrame.unionByName, dropped).groupBy("row").agg(F.collect_list("pos").alias("gone"))

    split = texts.join(gone, "row", "left").select("id", lines_of(F.col("text")).alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.size("gone") == 0, F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(stays, lambda i: F.get("lines", i)), "\n"))
    return split.select(F.col("id").alias(id_col), F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"), kept.alias("kept"))
