"""Data-quality checks that return a result table instead of printing.

Each check is one distributed aggregation or anti-join; nothing is collected
on the driver. Raising on failure is left to the caller (``assert_passed``).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quarry.plans.joins import join_bounded

DIGEST_BUCKETS = 4096  # of the digests that outputs are compared by


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """stage, rows: one count per named frame (a single job with one branch per frame)."""
    if not frames:
        raise ValueError("at least one frame is required")
    counted = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows") for name, df in frames.items()]
    result = counted[0]
    for frame in counted[1:]:
        result = result.unionByName(frame)
    return result


def counts_where(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """stage, rows: how many rows of ``df`` satisfy each predicate, in one pass over ``df``.

    Counting the rows a filter keeps next to the rows loaded costs one scan
    (and one evaluation of whatever joins build ``df``) instead of one per stage.
    """
    if not stages:
        raise ValueError("at least one stage is required")
    names = list(stages)
    counted = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(f"__c{i}") for i, cond in enumerate(stages.values())])
    per_stage = F.array(
        *[F.struct(F.lit(name).alias("stage"), F.col(f"__c{i}").alias("rows")) for i, name in enumerate(names)]
    )
    return counted.select(F.inline(per_stage))


def count_gate(df: DataFrame, expected: int | DataFrame, check: str = "record_count") -> DataFrame:
    """check, actual_rows, expected_rows, passed. ``expected`` is a number or a frame whose row count is expected."""
    if isinstance(expected, DataFrame):
        expected_rows = expected.agg(F.count(F.lit(1))).scalar()
    else:
        expected_rows = F.lit(int(expected)).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("actual_rows")).select(
        F.lit(check).alias("check"),
        "actual_rows",
        expected_rows.alias("expected_rows"),
        (F.col("actual_rows") == expected_rows).alias("passed"),
    )


class CountingPass:
    """Counts rows in the pass that reads them anyway, for a gate without a scan of its own.

    :meth:`watch` marks a point of a plan; after one action over it, :meth:`rows`
    tells how many rows went by. Use the marked frame in one action, or persist it.
    """

    def __init__(self):
        self._watched: dict[str, Observation] = {}

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        self._watched[stage] = Observation(f"{stage}-{uuid.uuid4().hex}")
        return df.observe(self._watched[stage], F.count(F.lit(1)).alias("rows"))

    def rows(self, stage: str) -> int:
        return self._watched[stage].get["rows"]

    def require(self, **expected: int | None) -> None:
        """Raise unless every stage with an expected count saw just that many rows."""
        for stage, rows in expected.items():
            if rows is not None and self.rows(stage) != rows:
                raise ValueError(f"{stage}: expected {rows} records, found {self.rows(stage)}")


def json_line_validity(lines: DataFrame, column: str = "value") -> DataFrame:
    """total_lines, valid_lines, invalid_lines for text lines that should each hold one JSON value.

    Validity is ``try_parse_json`` (null on malformed text; blank lines are
    invalid), with nothing else on the line. Differences from Python's ``json.loads``: NaN literals and
    duplicate object keys are rejected here.
    """
    # try_parse_json stops behind the first value; as the only element of an array it must be alone on its line
    alone = F.json_array_length(F.concat(F.lit("["), F.col(column), F.lit("]"))) == 1
    valid = F.coalesce(F.try_parse_json(F.col(column)).isNotNull() & alone, F.lit(False))
    return lines.agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(valid).alias("valid_lines"),
        F.count_if(~valid).alias("invalid_lines"),
    )


def expected_key_diff(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """key, status: keys expected but absent ("missing") and present but not expected ("unexpected").

    Both key sets are deduplicated first (map-side, so a hot key collapses
    before the shuffle) and compared in one full outer join: each side is
    shuffled and sorted once. Null keys never match, as in an anti-join.
    """
    have = actual.select(key).distinct().withColumn("__have", F.lit(True))
    want = expected.select(key).distinct().withColumn("__want", F.lit(True))
    both = have.join(want, key, "full_outer")
    return both.where(F.col("__have").isNull() | F.col("__want").isNull()).select(
        key, F.when(F.col("__have").isNull(), F.lit("missing")).otherwise(F.lit("unexpected")).alias("status")
    )


def bounds_check(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """rule, checked_rows, violations: rows where a rule's condition is not true (null counts as a violation)."""
    if not rules:
        raise ValueError("at least one rule is required")
    names = list(rules)
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(~F.coalesce(cond, F.lit(False))).alias(f"__v{i}") for i, cond in enumerate(rules.values())],
    )
    per_rule = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col("__rows").alias("checked_rows"), F.col(f"__v{i}").alias("violations"))
            for i, name in enumerate(names)
        ]
    )
    return counted.select(F.inline(per_rule))


def expected_counts_check(
    actual: DataFrame,
    expected: DataFrame,
    key: str = "word",
    count: str = "count",
) -> DataFrame:
    """key, expected_count, actual_count for every expectation that does not hold (absent = failure).

    ``actual`` may be vocabulary-sized: a semi-join against the (size-checked,
    broadcast) expected keys first keeps only the counts that are asked
    about, where they already are; only those few rows meet the expectations.
    """
    want = expected.select(key, F.col("expected_count").cast("bigint").alias("expected_count"))
    keys = want.select(key)
    asked = join_bounded(actual.select(key, F.col(count).alias("actual_count")), keys, key, "left_semi")
    return want.join(asked, key, "left").where(~F.col("actual_count").eqNullSafe(F.col("expected_count")))


def _signed(original: DataFrame, read_back: DataFrame) -> DataFrame:
    """Both frames' rows with ``__side`` (1 or -1), the two halves of a 128-bit digest of the row, and its ``__bucket``."""
    cols = original.columns
    both = original.select(*cols, F.lit(1).alias("__side")).unionByName(read_back.select(*cols, F.lit(-1).alias("__side")))
    first = F.xxhash64(*cols)
    both = both.withColumns({"__first": first, "__second": F.xxhash64(F.lit("second"), *cols)})
    return both.withColumn("__bucket", F.pmod("__first", F.lit(DIGEST_BUCKETS)).cast("int"))


def _differing_buckets(signed: DataFrame) -> DataFrame:
    """Buckets whose two sides do not hold the same rows.

    A side's digest of a bucket is its row count and the sums of its rows'
    digests, which no order or repetition changes; 32 bits are added up at a
    time, so that no sum overflows. Both sides go into one sum with opposite
    signs: one partial row a task and bucket crosses the shuffle.
    """
    low = F.lit((1 << 32) - 1)
    words = [F.col("__first").bitwiseAND(low), F.shiftrightunsigned("__first", 32), F.col("__second").bitwiseAND(low), F.shiftrightunsigned("__second", 32)]
    sums = [F.sum("__side").alias("__n"), *[F.sum(word * F.col("__side")).alias(f"__w{i}") for i, word in enumerate(words)]]
    totals = signed.groupBy("__bucket").agg(*sums)
    apart = F.lit(False)
    for name in ("__n", "__w0", "__w1", "__w2", "__w3"):
        apart = apart | (F.col(name) != 0)
    return totals.where(apart).select("__bucket")


def locate_differences(original: DataFrame, read_back: DataFrame) -> DataFrame:
    """The rows that one frame holds more often than the other, with ``missing_rows`` and ``extra_rows``.

    Digests of ``DIGEST_BUCKETS`` buckets are compared first, in one scan of
    either side; rows are read, and grouped by all their columns, in the
    differing buckets only. Where none differs, Spark drops that second part at
    run time and nothing but the digests is read or shuffled. Rows compare as in
    ``exceptAll``: nulls equal nulls, NaN equals NaN, and 0.0 equals -0.0.
    """
    cols = original.columns
    signed = _signed(original, read_back)
    # at most DIGEST_BUCKETS rows are broadcast
    suspects = signed.select(*cols, "__side", "__bucket").join(F.broadcast(_differing_buckets(signed)), "__bucket", "left_semi")
    surplus = suspects.groupBy(*cols).agg(F.sum("__side").alias("__n")).where(F.col("__n") != 0)
    return surplus.select(
        *cols,
        F.greatest(F.col("__n"), F.lit(0)).cast("bigint").alias("missing_rows"),
        F.greatest(-F.col("__n"), F.lit(0)).cast("bigint").alias("extra_rows"),
    )


def roundtrip_diff(original: DataFrame, read_back: DataFrame) -> DataFrame:
    """missing_rows, extra_rows: multiset difference both ways between a result and its read-back (see :func:`locate_differences`)."""
    return locate_differences(original, read_back).agg(
        F.coalesce(F.sum("missing_rows"), F.lit(0)).cast("bigint").alias("missing_rows"),
        F.coalesce(F.sum("extra_rows"), F.lit(0)).cast("bigint").alias("extra_rows"),
    )


def assert_passed(check: DataFrame, violation: Column) -> None:
    """Raise if any row of a check result satisfies ``violation`` (one small aggregate job)."""
    bad = check.where(violation).limit(1).count()
    if bad:
        raise AssertionError(f"data-quality check failed: {check.where(violation).limit(5).collect()}")
