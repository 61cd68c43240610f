"""Column types of text tables, found by one aggregation over the all-string scan.

Every column is tested against each type of a small lattice (int, bigint,
decimal, double, date, timestamp, boolean) in one pass with one partial row a
task; the narrowest type that all of its values have is its type, and string if
there is none. Unlike a reader's own inference the pass is an ordinary
aggregation: it can be planned, observed and combined with other counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from quarry.sources.files import read_csv

WHOLE = r"^[+-]?\d+$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
NOT_NUMBERS = ("NaN", "Inf", "-Inf")  # fixed values: how CSV text spells them
DATE = r"^\d{4}-\d{2}-\d{2}$"
MOMENT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
MOST_DIGITS = 38
LONG_DIGITS = 20  # digits of a decimal that also holds every bigint


def _tests(value: Column) -> dict[str, Column]:
    """For each type, whether a text that is not null is one of its values."""
    whole = value.rlike(WHOLE)
    digits = F.length(F.regexp_replace(value, r"^[+-]?0*", ""))
    return {
        "int": whole & value.try_cast("int").isNotNull(),
        "bigint": whole & value.try_cast("bigint").isNotNull(),
        "decimal": whole & (digits <= MOST_DIGITS),
        "double": value.rlike(NUMBER) | value.isin(*NOT_NUMBERS),
        "date": value.rlike(DATE) & value.try_cast("date").isNotNull(),
        "timestamp": value.rlike(MOMENT) & value.try_cast("timestamp").isNotNull(),
        "boolean": F.lower(value).isin("true", "false"),
    }


_TYPES: dict[str, DataType] = {
    "int": IntegerType(), "bigint": LongType(), "double": DoubleType(), "date": DateType(), "timestamp": TimestampType(), "boolean": BooleanType(),
}


def infer_types(texts: DataFrame) -> StructType:
    """The narrowest type of every (string) column of ``texts``: one job, one row to the driver.

    Nulls and empty texts have every type; a column without other values is a
    string, and so is one whose values share no type.
    """
    aggregates = []
    for i, name in enumerate(texts.columns):
        text = F.when(F.col(f"`{name}`") != "", F.col(f"`{name}`"))
        tests = _tests(text)
        aggregates += [F.count(text).alias(f"n{i}"), F.max(F.length(F.regexp_replace(text, r"^[+-]?0*", ""))).alias(f"digits{i}")]
        aggregates += [F.count_if(F.coalesce(test, F.lit(False))).alias(f"{kind}{i}") for kind, test in tests.items()]
    found = texts.agg(*aggregates).first()
    fields = []
    for i, name in enumerate(texts.columns):
        n = found[f"n{i}"]
        kind = next((k for k in _tests(F.lit("")) if n and found[f"{k}{i}"] == n), "string")
        if kind == "decimal":
            some_long = found[f"bigint{i}"] > 0
            made: DataType = DecimalType(max(found[f"digits{i}"], LONG_DIGITS if some_long else 1), 0)
        else:
            made = _TYPES.get(kind, StringType())
        fields.append(StructField(name, made, True))
    return StructType(fields)


def read_csv_typed(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV read with the types that :func:`infer_types` finds in its all-string scan."""
    return read_csv(spark, path, infer_types(read_csv(spark, path, header=header)), header=header)
