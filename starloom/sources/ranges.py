"""Ranges of a key column that hold about equally many rows, for parallel reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 10_000


def range_bounds(df: DataFrame, column: str, ranges: int) -> DataFrame:
    """(number, lower, upper): ranges of a column with about equally many rows each.

    ``lower`` is part of a range, ``upper`` isn't; the first has no lower and the last no upper
    end, so every value is in one range; rows without a value belong to the first. Bounds are
    the column's measured quantiles, not points of equal distance. A value that holds more than
    an average range is met by several quantiles: it becomes a range of its own, which no bound
    can split, and its rows are no burden to others. There are at most ``2 * ranges`` + 1 rows.
    The column holds integers, as keys do.
    """
    if not isinstance(df.schema[column].dataType, T.IntegralType):
        raise ValueError(f"{column} is not a column of integers")
    shares = [i / ranges for i in range(1, ranges)]
    cuts = df.agg(
        F.percentile_approx(column, shares, ACCURACY).alias("cuts") if shares else F.lit(None).alias("cuts"),
        F.min(column).alias("least"),
    )
    kind = df.schema[column].dataType.simpleString()
    if not shares:
        cuts = cuts.withColumn("cuts", F.array().cast(f"array<{kind}>"))
    found = F.coalesce("cuts", F.array().cast(f"array<{kind}>"))
    # A quantile that is met twice is a hot value: it ends one range and begins the one after it.
    hot = F.filter(found, lambda x, i: (i > 0) & (F.get(found, i - 1) == x))
    after = F.transform(F.array_distinct(hot), lambda x: x + F.lit(1).cast(kind))
    bounds = F.array_sort(F.array_distinct(F.concat(found, after)))
    # A bound at the least value would leave the first range empty.
    bounds = F.filter(bounds, lambda x: x > F.col("least"))
    lower = F.concat(F.array(F.lit(None).cast(kind)), bounds)
    upper = F.concat(bounds, F.array(F.lit(None).cast(kind)))
    return cuts.select(F.posexplode(F.arrays_zip(lower.alias("lower"), upper.alias("upper"))).alias("number", "r")).select(
        "number", F.col("r.lower").alias("lower"), F.col("r.upper").alias("upper")
    )


def in_range(value: Column, lower: Column, upper: Column) -> Column:
    """Whether a value lies in a range; one that is missing is in the first."""
    return F.when(value.isNull(), lower.isNull()).otherwise(
        (lower.isNull() | (value >= lower)) & (upper.isNull() | (value < upper))
    )


def predicates(bounds: DataFrame, column: str) -> list[str]:
    """The ranges as SQL conditions, one parallel read each; few, so they are named by the driver."""

    def literal(value: object) -> str:
        return str(value) if isinstance(value, (int, float)) else f"'{value}'"

    found = []
    for row in bounds.orderBy("number").collect():
        ends = []
        if row["lower"] is not None:
            ends.append(f"{column} >= {literal(row['lower'])}")
        if row["upper"] is not None:
            ends.append(f"{column} < {literal(row['upper'])}")
        condition = " and ".join(ends) or "1 = 1"
        found.append(condition if row["lower"] is not None else f"({condition} or {column} is null)")
    return found
