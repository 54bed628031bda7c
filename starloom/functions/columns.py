"""Column lists computed from a DataFrame's own metadata."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filtered_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns of ``df`` in source order, minus ``exclude`` (case-insensitive).

    An excluded name that matches no column is most often a typing error, so it
    is reported as a warning.
    """
    excluded = {name.lower() for name in exclude}
    unknown = excluded - {name.lower() for name in df.columns}
    if unknown:
        warnings.warn(f"excluded names match no column: {sorted(unknown)}", stacklevel=2)
    return [name for name in df.columns if name.lower() not in excluded]


def prefixed(columns: Iterable[str], prefix: str) -> dict[str, str]:
    """Map each column to its prefixed output name."""
    return {name: f"{prefix}{name}" for name in columns}


def interleaved(columns: Iterable[str], prefixes: Sequence[str]) -> list[str]:
    """Output names of several prefixed copies, alternating column by column."""
    return [f"{prefix}{name}" for name in columns for prefix in prefixes]


def replace_columns(df: DataFrame, replacements: dict[str, Column]) -> DataFrame:
    """Drop the named columns and add their replacements at the end."""
    kept = [name for name in df.columns if name not in replacements]
    return df.select(*kept, *[value.alias(name) for name, value in replacements.items()])


def rename_select(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Pick the mapped columns and give them their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])
