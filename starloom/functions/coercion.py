"""Type policies: a rule from source type to target type, applied as casts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TypeRule = Callable[[T.DataType], T.DataType]
TableCallback = Callable[[str, DataFrame], DataFrame]


def _coerced(column: T.StructField, target: T.DataType) -> Column:
    value = F.col(column.name)
    if target == column.dataType:
        return value
    if isinstance(target, T.StringType) and isinstance(
        column.dataType, (T.ArrayType, T.MapType, T.StructType)
    ):
        return F.to_json(value).alias(column.name)
    return value.cast(target).alias(column.name)


def adapt_types(df: DataFrame, rule: TypeRule) -> DataFrame:
    """Ask ``rule`` for each column's target type; nested values become JSON text."""
    return df.select(*[_coerced(c, rule(c.dataType)) for c in df.schema.fields])


def adapt_table(df: DataFrame, table: str, callback: TableCallback) -> DataFrame:
    """Let a callback edit a table's columns before it is loaded."""
    return df.transform(lambda source: callback(table, source))


def drop_column(table: str, column: str) -> TableCallback:
    """Callback that drops one column of one table and leaves other tables alone."""
    return lambda name, df: df.drop(column) if name == table else df


def doubles_as_double(kind: T.DataType) -> T.DataType:
    """Approximate numbers stay as they are, nothing turns into a decimal."""
    return kind


def floats_as_decimal(precision: int = 38, scale: int = 9) -> TypeRule:
    """Approximate numbers become exact decimals."""

    def rule(kind: T.DataType) -> T.DataType:
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return T.DecimalType(precision, scale)
        return kind

    return rule


def decimals_as_text(kind: T.DataType) -> T.DataType:
    """Exact numbers verbatim, as text."""
    return T.StringType() if isinstance(kind, T.DecimalType) else kind


def arrays_as_json(kind: T.DataType) -> T.DataType:
    """Arrays, which many targets cannot hold, become JSON text."""
    return T.StringType() if isinstance(kind, T.ArrayType) else kind


def chain(*rules: TypeRule) -> TypeRule:
    """Apply rules in turn, each seeing the type the one before it chose."""

    def rule(kind: T.DataType) -> T.DataType:
        for step in rules:
            kind = step(kind)
        return kind

    return rule
