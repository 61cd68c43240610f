"""Order statistics without funnelling a group through one task.

``Window.partitionBy(g).orderBy(v)`` and the exact ``percentile``/``median``
aggregates send every row of a group to a single task: a group holding a
third of a 100 TB table would not fit.

* Global row numbers range-partition on the ordering keys with a digest of the
  row behind them, so that rows of one value are split over partitions as well;
  a row's number is its place in its partition plus the rows before it.
* Medians are selected without a sort: an approximate quantile sketch brackets
  a group's middle, exact counts tell how many values lie below the bracket, a
  histogram narrows the bracket where it still holds many rows, and only the
  distinct values left in it are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.plans.joins import DEFAULT_BROADCAST_ROWS, has_at_most, join_bounded, join_null_safe
from quarry.plans.storage import ensure_checkpoint_dir

# Spark's exact ``median`` aggregate keeps a group's values (with counts) in one
# aggregation buffer. Up to this many rows per group that buffer stays at a
# few tens of MB, so bounded groups take that single aggregation; larger ones
# are selected by brackets below.
DEFAULT_GROUP_ROWS = 1_000_000

ACCURACY = 10_000  # of the quantile sketch: ranks are off by at most a group's rows over this
BUCKETS = 4096  # of a histogram over a bracket
_PLACE_BITS = 33  # of the place within a partition in a monotonically increasing id


def groups_at_most(df: DataFrame, group_cols: list[str], max_rows: int) -> bool:
    """True when no group of ``df`` holds more than ``max_rows`` rows (one aggregate job)."""
    return largest_group(df, group_cols) <= max_rows


def largest_group(df: DataFrame, group_cols: list[str]) -> int:
    """Rows of the largest group (one aggregate job; one number reaches the driver)."""
    counts = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("__rows"))
    return counts.agg(F.max("__rows")).first()[0] or 0


def range_checkpoint(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """``df`` range-partitioned and sorted on ``order_cols``, written, with ``__pid`` and ``__place`` (from 0) of every row.

    A digest of the whole row and its number where it came from follow the
    ordering columns, so rows of one value spread over as many partitions as
    they fill. The checkpoint in the shared folder keeps both columns fixed over
    the reads that follow and when an executor is lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    spread = df.withColumns({"__digest": F.xxhash64(*df.columns), "__row": F.monotonically_increasing_id()})
    keys = [*[F.col(c) for c in order_cols], F.col("__digest"), F.col("__row")]
    placed = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__digest", "__row")
    at = F.monotonically_increasing_id()
    tagged = placed.withColumns({"__pid": F.shiftright(at, _PLACE_BITS), "__place": at.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))})
    return tagged.checkpoint(eager=True)


def global_row_number(
    df: DataFrame,
    order_cols: list[str],
    name: str = "rank",
    max_single_task_rows: int | None = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """1-based position of each row in the total order ``order_cols`` (ties broken arbitrarily).

    Same result as ``row_number()`` over an unpartitioned window. That window
    is used as is only when a check proves ``df`` has at most
    ``max_single_task_rows`` rows (e.g. one row per configuration); beyond
    that no task ever holds more than one range partition, however many rows
    share a value.
    """
    ordering = [F.col(c) for c in order_cols]
    if max_single_task_rows is not None and has_at_most(df, max_single_task_rows):
        return df.withColumn(name, F.row_number().over(Window.orderBy(*ordering)).cast("long"))
    tagged = range_checkpoint(df, order_cols)
    sizes = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__rows"))
    # One row per partition: the prefix sum runs over #partitions rows only.
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__pid", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    numbered = join_bounded(tagged, offsets, "__pid").withColumn(name, F.col("__offset") + F.col("__place") + 1)
    return numbered.drop("__pid", "__place", "__offset")


def _bucket(value: Column) -> Column:
    """Bucket of a value in its bracket; falls with no value, so buckets are in the values' order."""
    share = (value - F.col("__from")) / (F.col("__to") - F.col("__from"))
    inner = F.least(F.greatest(F.floor(share * BUCKETS), F.lit(0)), F.lit(BUCKETS - 1))
    # a bracket of one value, or one that ends at an infinity, is not divided
    usable = (F.col("__to") > F.col("__from")) & (F.col("__to") < float("inf")) & (F.col("__from") > float("-inf")) & (F.col("__to") - F.col("__from") < float("inf"))
    return F.when(usable, inner).otherwise(F.lit(0)).cast("int")


def exact_median(
    df: DataFrame,
    group_cols: list[str],
    value_col: str,
    name: str = "median",
    max_group_rows: int | None = DEFAULT_GROUP_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Exact per-group median (linear interpolation, as ``median``/``percentile(0.5)``).

    When a check proves every group holds at most ``max_group_rows`` rows,
    Spark's ``median`` aggregate is used directly (``largest`` passes a
    group size already measured). Otherwise, or with ``max_group_rows=None``,
    the middle is selected by narrowing, lazily and without writing anything:

    1. A quantile sketch per group (partial aggregation) brackets the middle.
    2. Exact counts per group: values below the bracket, and in the bracket
       per distinct value; where the bracket may hold more than
       ``max_group_rows`` rows, a histogram of it comes first and only the
       buckets that hold the middle go on.
    3. The distinct values left are ranked with their counts.

    A value that fills a third of a group is one row from the first aggregation
    on. Null values are ignored and null groups kept; NaN sorts above every
    number, as in Spark.
    """
    groups = list(group_cols)
    if max_group_rows is not None:
        if largest is None:
            largest = largest_group(df, groups)
        if largest <= max_group_rows:
            return df.groupBy(*groups).agg(F.median(value_col).alias(name))
    value = F.col(value_col).cast("double")
    # NaN stands with +infinity until single values are ranked
    rows = df.select(*groups, value.alias("__v"), F.when(F.isnan(value), float("inf")).otherwise(value).alias("__w"))
    step = 2.0 / ACCURACY
    sketch = F.percentile_approx("__w", [0.5 - step, 0.5 + step], ACCURACY)
    brackets = rows.groupBy(*groups).agg(F.count("__v").alias("__n"), sketch.alias("__q"))
    brackets = brackets.select(*groups, "__n", F.col("__q")[0].alias("__from"), F.col("__q")[1].alias("__to"))
    known = rows.where(F.col("__v").isNotNull())
    met = join_null_safe(known, brackets, groups)
    below = met.where(F.col("__w") < F.col("__from")).groupBy(*groups).agg(F.count(F.lit(1)).alias("__below"))
    inside = met.where(F.col("__w").between(F.col("__from"), F.col("__to")))
    # 0-based middle positions: equal for odd totals, adjacent for even.
    middles = {"__lo": F.floor((F.col("__n") - 1) / 2), "__hi": F.ceil((F.col("__n") - 1) / 2)}
    starts = join_null_safe(brackets, below, groups, "left").withColumn("__below", F.coalesce("__below", F.lit(0)))
    starts = starts.withColumns(middles)

    if max_group_rows is None or largest * 2 * step > max_group_rows:
        counted = inside.groupBy(*groups, _bucket(F.col("__w")).alias("__bucket")).agg(F.count(F.lit(1)).alias("__rows"))
        spans = join_null_safe(counted, starts.select(*groups, "__below", "__lo", "__hi"), groups)
        by_bucket = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
        spans = spans.withColumn("__start", F.col("__below") + F.coalesce(F.sum("__rows").over(by_bucket), F.lit(0)))
        end = F.col("__start") + F.col("__rows")
        holds = [(F.col(m) >= F.col("__start")) & (F.col(m) < end) for m in ("__lo", "__hi")]
        kept = spans.where(holds[0] | holds[1]).select(*groups, "__bucket", "__start", "__lo", "__hi")
        inside = inside.withColumn("__bucket", _bucket(F.col("__w")))
        distinct = inside.groupBy(*groups, "__bucket", "__v").agg(F.count(F.lit(1)).alias("__rows"))
        ranks = join_null_safe(distinct, kept, [*groups, "__bucket"])
        before = Window.partitionBy(*groups, "__bucket").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    else:
        distinct = inside.groupBy(*groups, "__v").agg(F.count(F.lit(1)).alias("__rows"))
        ranks = join_null_safe(distinct, starts.select(*groups, F.col("__below").alias("__start"), "__lo", "__hi"), groups)
        before = Window.partitionBy(*groups).orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("__start") + F.coalesce(F.sum("__rows").over(before), F.lit(0))
    ranked = ranks.withColumn("__first", first).withColumn("__last", F.col("__first") + F.col("__rows") - 1)

    def value_at(position: str) -> Column:
        return F.max(F.when((F.col(position) >= F.col("__first")) & (F.col(position) <= F.col("__last")), F.col("__v")))

    picked = ranked.groupBy(*groups).agg(value_at("__lo").alias("__v_lo"), value_at("__hi").alias("__v_hi"))
    middle = F.when(F.col("__v_lo") == F.col("__v_hi"), F.col("__v_lo")).otherwise(F.col("__v_lo") * 0.5 + F.col("__v_hi") * 0.5)
    # groups whose values are all null have a row with a null median, as with ``median``
    return join_null_safe(brackets.select(*groups), picked.select(*groups, middle.alias(name)), groups, "left")
