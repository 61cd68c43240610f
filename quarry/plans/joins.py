"""Joins against dimension-like sides whose size is checked before broadcasting."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A broadcast side is shipped to every executor and held in memory there, so
# both its row count and the bytes of its values are bounded (Spark's hard
# limit is 8 GB; these keep the built hash table to a few hundred MB).
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024

# Fixed widths in bytes of the values of fixed-size types.
_FIXED_WIDTHS = {
    "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
    "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}


def row_bytes(df: DataFrame) -> Column:
    """Bytes of one row's values: fixed widths plus the exact length of variable-width values."""
    sizes: list[Column] = []
    fixed = 0
    for field in df.schema.fields:
        name = field.dataType.simpleString()
        if name in _FIXED_WIDTHS:
            fixed += _FIXED_WIDTHS[name]
        elif name.startswith("decimal"):
            fixed += 16
        elif name in ("string", "binary"):
            sizes.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        else:
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(field.name)))), F.lit(0)))
    total = F.lit(fixed).cast("bigint")
    for size in sizes:
        total = total + size
    return total


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True when ``df`` has no more than ``max_rows`` rows (and ``max_bytes`` bytes of values, if given)."""
    return bounded_sides({"df": df}, max_rows, max_bytes)["df"]


def bounded_sides(
    frames: Mapping[str, DataFrame],
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    max_bytes: int | None = DEFAULT_BROADCAST_BYTES,
) -> dict[str, bool]:
    """Whether each frame has at most ``max_rows`` rows and ``max_bytes`` bytes of values: one Spark job.

    Exact counts and sizes: every task aggregates its own rows and only one
    partial row per task and frame crosses the shuffle (``limit(max_rows + 1)``
    would instead move up to ``max_rows + 1`` rows from every task into a
    single reducer). Only variable-width columns are read for the size;
    without ``max_bytes`` a base-table count reads no column data at all.
    """
    names = list(frames)
    if not names:
        return {}
    tagged = [
        frames[n].select(
            F.lit(i).alias("__side"),
            (row_bytes(frames[n]) if max_bytes is not None else F.lit(0).cast("bigint")).alias("__bytes"),
        )
        for i, n in enumerate(names)
    ]
    union = tagged[0]
    for part in tagged[1:]:
        union = union.unionByName(part)
    measured = union.groupBy("__side").agg(F.count(F.lit(1)).alias("__rows"), F.sum("__bytes").alias("__bytes"))
    sizes = {r["__side"]: (r["__rows"], r["__bytes"]) for r in measured.collect()}
    verdict = {}
    for i, n in enumerate(names):
        rows, size = sizes.get(i, (0, 0))
        verdict[n] = rows <= max_rows and (max_bytes is None or (size or 0) <= max_bytes)
    return verdict


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def join_bounded(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str] | Column,
    how: str = "inner",
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    small: bool | None = None,
    max_bytes: int | None = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """``left.join(right)``, broadcasting ``right`` only after proving it is small.

    ``small`` passes a verdict already established (e.g. by
    :func:`bounded_sides`). Beyond ``max_rows`` rows or ``max_bytes`` bytes the join is left to
    Catalyst/AQE: a sort-merge join whose skewed partitions AQE splits, or a
    runtime switch to broadcast once shuffle statistics show a side is small.
    """
    if small is None:
        small = has_at_most(right, max_rows, max_bytes)
    return left.join(broadcast_if(right, small), on, how)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal ``keys`` where null equals null; the result has ``left``'s key columns."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"__r_{k}"])
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])
