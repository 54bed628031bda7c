"""Two tables stored by the same key, so that they are joined where they lie.

Rows and headers are written in as many buckets of their key, sorted by it; a join of the two then
reads bucket beside bucket and shuffles nothing, as often as it is asked for. Rows of hot keys, found
as for shuffled lookups (NULL is a key too), would make one bucket as large as they are: they are
stored apart, in as many files as they need, with the few headers of their keys, which are
broadcast once measured. The layout is paid for once, when the tables are written.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookup import JoinLimits, Lookup, fits_broadcast, hot_keys, left_lookups


@dataclass(frozen=True)
class Colocated:
    """``rows`` and ``headers`` in equal buckets of ``key``; the hot keys' rows and headers."""

    rows: DataFrame
    headers: DataFrame
    key: str
    header_key: str
    hot_rows: DataFrame | None = None
    hot_headers: DataFrame | None = None


def _bucketed(df: DataFrame, folder: str, name: str, key: str, buckets: int) -> DataFrame:
    """A table of files under ``folder``; its name is known to this session's catalog only."""
    table = f"starloom_{name}_{uuid.uuid4().hex}"
    (
        # One file a bucket: whoever writes a bucket has all of it.
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", f"{folder}/{name}")
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def _plain(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def store_colocated(
    rows: DataFrame,
    headers: DataFrame,
    key: str,
    header_key: str,
    folder: str,
    buckets: int,
    limits: JoinLimits = JoinLimits(),
) -> Colocated:
    """Write both tables by their key under ``folder``.

    ``buckets`` is such that one of the larger table fits an executor's task, some hundred
    megabytes; a key with more rows than an average bucket is hot.
    """
    share = limits.hot_share or 1 / buckets
    hot = hot_keys(rows, [key], JoinLimits(hot_share=share)).get(key)
    if hot is None:
        return Colocated(
            _bucketed(rows, folder, "rows", key, buckets),
            _bucketed(headers, folder, "headers", header_key, buckets),
            key,
            header_key,
        )
    hot = hot.select("__hot_key")
    # No more keys than have an average bucket each.
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot
    is_hot = F.col(key).eqNullSafe(F.col("__hot_key"))
    has_hot = F.col(header_key).eqNullSafe(F.col("__hot_key"))
    return Colocated(
        _bucketed(rows.join(hot, is_hot, "left_anti"), folder, "rows", key, buckets),
        _bucketed(headers, folder, "headers", header_key, buckets),
        key,
        header_key,
        _plain(rows.join(hot, is_hot, "left_semi"), folder, "hot_rows"),
        _plain(headers.join(hot, has_hot, "left_semi"), folder, "hot_headers"),
    )


def colocated_lookup(
    stored: Colocated, take: dict[str, str], limits: JoinLimits = JoinLimits()
) -> DataFrame:
    """Keep every row and add the columns that ``take`` maps from its header; nothing is shuffled."""
    columns = stored.rows.columns
    headers = stored.headers.select(
        F.col(stored.header_key).alias("__header_key"),
        *[F.col(name).alias(f"__take_{name}") for name in take],
    )
    taken = [F.col(f"__take_{name}").alias(out) for name, out in take.items()]
    same = F.col(stored.key) == F.col("__header_key")
    joined = stored.rows.join(headers.hint("merge"), same, "left").select(*columns, *taken)
    if stored.hot_rows is None:
        return joined
    header = Lookup(stored.hot_headers, stored.key, stored.header_key, take)
    # Without names to spread by no salt is looked for: these headers are few and measured.
    hot = left_lookups(stored.hot_rows, [header], [], limits)
    return joined.unionByName(hot.select(*joined.columns))
