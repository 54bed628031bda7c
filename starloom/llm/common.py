"""What the operators on text share."""

from __future__ import annotations

import os
import string
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.lookup import JoinLimits, fits_broadcast
from starloom.sources.workspace import new_workspace

# White space as the word rules see it: space, tab, line feed to carriage return.
SPACES = " \t\n\x0b\f\r"
# A word: a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"

# Bytes a table may have to be broadcast as a whole, and rows, which are counted before.
BROADCAST_BYTES = 48 << 20
BROADCAST_ROWS = 1_000_000


def show_library(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it.

    A cluster gets it with ``--py-files`` or as an installed package; this is for sessions
    that were started elsewhere on the same machine.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column, with null as the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` is the faster way for plain ASCII text."""
    plain = F.length(text) == F.octet_length(text)
    other = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(other)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """The frame as a table in the shared folder: later reads do not depend on executors.

    ``files`` is how many a table of known size needs at most.
    """
    spark = df.sparkSession
    path = f"{new_workspace(spark)}/{name}"
    (df.coalesce(files) if files else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits(side: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether a written table is measured small enough to be broadcast, by rows and bytes."""
    limits = JoinLimits(broadcast_rows=BROADCAST_ROWS if most > 0 else 0, broadcast_bytes=most)
    return fits_broadcast(side, limits)


def join_measured(
    df: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    most: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``side``, a written table, by broadcast if it is measured small, else by shuffle.

    The shuffled join is left to adaptive execution, which splits a hot key of ``df``.
    """
    return df.join(F.broadcast(side) if fits(side, most) else side, list(keys), how)
