"""Record cleaning: drop incomplete rows, keep strictly positive amounts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def is_complete(df: DataFrame, subset: Sequence[str] | None = None) -> Column:
    """True for rows with no null -- and no NaN in a floating column -- in ``subset`` (all columns by default).

    The same rows as ``na.drop(how="any")`` keeps, but written as plain
    ``IS NOT NULL`` / ``NOT isnan`` conjuncts, which Spark pushes into the
    scan (``na.drop`` plans as ``AtLeastNNonNulls``, which it cannot push).
    """
    wanted = set(subset) if subset else None
    conditions = []
    for field in df.schema.fields:
        if wanted is not None and field.name not in wanted:
            continue
        column = F.col(field.name)
        conditions.append(column.isNotNull())
        if isinstance(field.dataType, (FloatType, DoubleType)):
            conditions.append(~F.isnan(column))
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any null -- or NaN in a floating column -- in ``subset`` (all columns by default).

    Checking all columns forces the scan to read all of them; pass ``subset``
    when only some columns feed the later reports.
    """
    return df.where(is_complete(df, subset))


def keep_positive(df: DataFrame, column: str = "amount") -> DataFrame:
    """Keep rows whose ``column`` is strictly greater than zero (pushed into the scan)."""
    return df.where(F.col(column) > 0)


def is_clean(df: DataFrame, amount: str = "amount", subset: Sequence[str] | None = None) -> Column:
    """The cleaning rule as one predicate: complete row and strictly positive ``amount``."""
    return is_complete(df, subset) & (F.col(amount) > 0)


def clean_transactions(
    df: DataFrame,
    amount: str = "amount",
    subset: Sequence[str] | None = None,
) -> DataFrame:
    """Null/NaN rows out, then non-positive amounts out (one fused Filter)."""
    return df.where(is_clean(df, amount, subset))
