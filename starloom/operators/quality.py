"""Data checks. Each returns the failing rows: an empty result is a pass.

Keys are counted before anything is joined or returned, so a key that repeats a
billion times is one row.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookup import JoinLimits, Lookup, fits_broadcast, near_dims


@dataclass(frozen=True)
class Edge:
    """``relation.column`` must exist as ``target.target_key``."""

    relation: str
    column: str
    target: str
    target_key: str


# References of the star schema.
STAR_EDGES = (
    Edge("fact_sales_order_line", "customer_key", "dim_customer", "customer_key"),
    Edge("fact_sales_order_line", "stock_item_key", "dim_stock_item", "stock_item_key"),
    Edge("fact_sales_order_line", "package_type_key", "dim_package_type", "package_type_key"),
    Edge("fact_sales_order_line", "salesperson_key", "dim_person", "person_key"),
    Edge("fact_sales_order_line", "picked_by_person_key", "dim_person", "person_key"),
    Edge("fact_sales_order_line", "contact_person_key", "dim_person", "person_key"),
    Edge("fact_sales_order_line", "order_date_key", "dim_date", "date_key"),
    Edge("fact_sales_order_line", "expected_delivery_date_key", "dim_date", "date_key"),
    Edge(
        "fact_sales_order_line", "sales_order_picking_completed_date_key", "dim_date", "date_key"
    ),
    Edge(
        "fact_sales_order_line",
        "sales_order_line_picking_completed_date_key",
        "dim_date",
        "date_key",
    ),
    Edge("dim_customer", "bill_to_customer_key", "dim_customer", "customer_key"),
)

# Naming rules for columns.
SNAKE_CASE = r"[a-z][a-z0-9]*(_[a-z0-9]+)*"
BOOLEAN_NAME = r"(.*_)?is_.+"


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def _key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])


def unique(df: DataFrame, relation: str, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter("row_count > 1")
        .select(
            F.lit(relation).alias("relation"),
            F.lit("|".join(keys)).alias("key_columns"),
            _key_text(keys).alias("key_value"),
            "row_count",
        )
    )


def unique_all(checks: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    return _union([unique(df, relation, keys) for df, relation, keys in checks])


def not_null(df: DataFrame, relation: str, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per missing value: which row and which column. One scan for all columns."""
    missing = F.array_compact(
        F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in columns])
    )
    return df.select(
        F.lit(relation).alias("relation"),
        F.col(key).cast("string").alias("key_value"),
        F.explode(missing).alias("column_name"),
    )


def relationship(df: DataFrame, target: DataFrame, edge: Edge, small: bool) -> DataFrame:
    """Key values without a counterpart, with the number of rows that use them.

    ``small`` says that the target's keys were measured and may be broadcast.
    """
    used = (
        df.filter(F.col(edge.column).isNotNull())
        .groupBy(F.col(edge.column).alias("used_key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = target.select(F.col(edge.target_key).alias("known_key"))
    if small:
        known = F.broadcast(known)
    return used.join(known, F.col("used_key") == F.col("known_key"), "left_anti").select(
        F.lit(edge.relation).alias("relation"),
        F.lit(edge.column).alias("column_name"),
        F.col("used_key").cast("string").alias("key_value"),
        "row_count",
    )


def relationships(
    tables: Mapping[str, DataFrame],
    edges: Sequence[Edge] = STAR_EDGES,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    keys = [Lookup(tables[e.target], e.column, e.target_key) for e in edges]
    small = near_dims(keys, limits)
    return _union(
        [
            relationship(tables[e.relation], lookup.dim, e, id(lookup.dim) in small)
            for e, lookup in zip(edges, keys, strict=True)
        ]
    )


def freshness(
    df: DataFrame, relation: str, column: str, now: Column, warn_hours: int, error_hours: int
) -> DataFrame:
    """Age of the newest row against two thresholds; ``error`` too when there is none."""
    latest = df.agg(F.max(F.col(column).cast("timestamp")).alias("latest"))
    age = F.floor((F.unix_seconds(now) - F.unix_seconds("latest")) / 3600)
    status = (
        F.when(age < warn_hours, "pass").when(age < error_hours, "warn").otherwise("error")
    )
    return latest.select(
        F.lit(relation).alias("relation"), "latest", age.alias("age_hours"), status.alias("status")
    )


def reconcile(
    source: DataFrame, warehouse: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Row counts and sums per key, source beside warehouse.

    Both sides are aggregated before they meet, so what is joined is one row per
    key however many rows stand behind it.
    """

    def totals(df: DataFrame, side: str) -> DataFrame:
        sums = [F.sum(name).alias(f"{side}_{name}") for name in measures]
        return df.groupBy(*[F.col(k).alias(f"{side}_key_{k}") for k in keys]).agg(
            F.count(F.lit(1)).alias(f"{side}_rows"), *sums
        )

    pairs = [f"{name}" for name in ("rows", *measures)]
    same_key = [F.col(f"source_key_{k}").eqNullSafe(F.col(f"warehouse_key_{k}")) for k in keys]
    agree = [F.col(f"source_{p}").eqNullSafe(F.col(f"warehouse_{p}")) for p in pairs]
    both = totals(source, "source").join(
        totals(warehouse, "warehouse"), functools.reduce(Column.__and__, same_key), "full"
    )
    return both.select(
        *[F.coalesce(f"source_key_{k}", f"warehouse_key_{k}").alias(k) for k in keys],
        *[f"{side}_{p}" for p in pairs for side in ("source", "warehouse")],
        functools.reduce(Column.__and__, agree).alias("matches"),
    )


def mismatched_rows(source: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Rows on one side only, with multiplicity: one pass over both sides, no join."""
    columns = source.columns
    signed = source.withColumn("__side", F.lit(1)).unionByName(
        warehouse.select(*columns).withColumn("__side", F.lit(-1))
    )
    return (
        signed.groupBy(*columns)
        .agg(F.sum("__side").alias("surplus"))
        .filter("surplus <> 0")
    )


def bucket_digests(df: DataFrame, key: str, width: int, columns: Sequence[str]) -> DataFrame:
    """(bucket, rows, total, parity): what a range of ``width`` keys holds, in any order.

    Each row becomes a hash of all its columns; a bucket has their number, sum and XOR. Two
    sides with equal digests have equal rows but for a chance of some 2 ^ -64 a bucket.
    """
    bucket = F.floor(F.col(key) / width).alias("bucket")
    row = F.xxhash64(*columns)
    return df.groupBy(bucket).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(row.cast("decimal(20,0)")).alias("total"),
        F.bit_xor(row).alias("parity"),
    )


def differing_buckets(
    source: DataFrame, warehouse: DataFrame, key: str, width: int, columns: Sequence[str]
) -> DataFrame:
    """The buckets of keys whose rows aren't the same on both sides; a NULL key has its own."""
    sides = [
        bucket_digests(df, key, width, columns).select(
            F.col("bucket").alias(f"{side}_bucket"), F.struct("rows", "total", "parity").alias(side)
        )
        for df, side in ((source, "source"), (warehouse, "warehouse"))
    ]
    both = sides[0].join(sides[1], F.col("source_bucket").eqNullSafe(F.col("warehouse_bucket")), "full")
    return both.filter(~F.col("source").eqNullSafe(F.col("warehouse"))).select(
        F.coalesce("source_bucket", "warehouse_bucket").alias("bucket")
    )


def key_ranges(buckets: Sequence[int], most: int) -> list[tuple[int, int]]:
    """Buckets as runs, first and last; the closest are put together until there are ``most``."""
    ordered = sorted(set(buckets))
    by_gap = sorted(range(1, len(ordered)), key=lambda i: ordered[i] - ordered[i - 1], reverse=True)
    breaks = sorted(i for i in by_gap[: most - 1] if ordered[i] > ordered[i - 1] + 1)
    starts = [0, *breaks] if ordered else []
    ends = [*breaks, len(ordered)]
    return [(ordered[a], ordered[b - 1]) for a, b in zip(starts, ends)]


def mismatched_rows_by_digest(
    source: DataFrame,
    warehouse: DataFrame,
    key: str,
    width: int,
    most_ranges: int = 64,
) -> DataFrame:
    """As :func:`mismatched_rows`, comparing rows only where a bucket of keys differs.

    What is shuffled of the buckets that agree is a digest a bucket and task. The second step
    reads the key ranges of the others only, by filters that reach the scan: ``width`` is
    chosen so that buckets are few enough to be named by the driver (a billion keys in a bucket
    is none too wide), and ranges beyond ``most_ranges`` are read together with what is between
    them. Both sides should be laid out by the key.
    """
    columns = source.columns
    found = differing_buckets(source, warehouse, key, width, columns).collect()
    buckets = [int(row["bucket"]) for row in found if row["bucket"] is not None]
    wanted = F.col(key).isNull() if len(buckets) < len(found) else F.lit(False)
    for first, last in key_ranges(buckets, most_ranges):
        wanted = wanted | ((F.col(key) >= first * width) & (F.col(key) < (last + 1) * width))
    return mismatched_rows(source.filter(wanted), warehouse.filter(wanted))


def _bitmaps(df: DataFrame, key: str, *counts: Column) -> DataFrame:
    """(bucket, bits, counts): the integer keys of each range of 32,768 as one bitmap."""
    value = F.col(key)
    return (
        df.filter(value.isNotNull())
        .groupBy(F.bitmap_bucket_number(value).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"), *counts)
    )


def _in_buckets(df: DataFrame, key: str, buckets: DataFrame) -> DataFrame:
    """Rows whose key is in one of the buckets, which are measured before they are broadcast."""
    buckets = buckets.select(F.col("bucket").alias("__bucket"))
    buckets = F.broadcast(buckets) if fits_broadcast(buckets) else buckets
    return df.join(buckets, F.bitmap_bucket_number(key) == F.col("__bucket"), "left_semi")


def unique_by_bitmap(df: DataFrame, relation: str, key: str) -> DataFrame:
    """As :func:`unique` for one integer key, by bitmaps.

    A range of keys with as many bits as rows holds each once. What is shuffled is a bitmap for
    32,768 keys and task, 4 KB, so keys should be dense, as running numbers are; rows are counted
    by key only in ranges with fewer bits than rows. Several rows without a key are one repeated
    key, as there.
    """
    ranges = _bitmaps(df, key, F.count(F.lit(1)).alias("rows"))
    repeated = ranges.filter(F.bitmap_count("bits") < F.col("rows"))
    suspect = _in_buckets(df, key, repeated).unionByName(df.filter(F.col(key).isNull()))
    return unique(suspect, relation, [key])


def relationship_by_bitmap(df: DataFrame, target: DataFrame, edge: Edge) -> DataFrame:
    """As :func:`relationship` for integer keys, by bitmaps of both sides.

    The keys in use and the known ones of a range, OR-ed, have no more bits than the known ones
    alone, or one is missing. Only in such ranges are keys themselves compared.
    """
    known = _bitmaps(target, edge.target_key).withColumn("is_known", F.lit(True))
    used = _bitmaps(df, edge.column).withColumn("is_known", F.lit(False))
    empty = F.lit(None).cast("binary")
    of_known = F.when(F.col("is_known"), F.col("bits")).otherwise(empty)
    missing = (
        known.unionByName(used)
        .groupBy("bucket")
        .agg(F.bitmap_or_agg("bits").alias("all"), F.bitmap_or_agg(of_known).alias("known"))
        .filter(F.bitmap_count("all") > F.coalesce(F.bitmap_count("known"), F.lit(0)))
    )
    return relationship(
        _in_buckets(df, edge.column, missing), _in_buckets(target, edge.target_key, missing), edge, False
    )


def naming(df: DataFrame, relation: str) -> list[tuple[str, str]]:
    """Columns that break a naming rule, with the rule. Warnings, not failures."""
    found = []
    for column in df.schema.fields:
        kind = column.dataType.simpleString()
        if not re.fullmatch(SNAKE_CASE, column.name):
            found.append((column.name, "snake_case"))
        if kind == "boolean" and not re.fullmatch(BOOLEAN_NAME, column.name):
            found.append((column.name, "boolean starts with is_"))
        if column.name.endswith("_key") and kind in ("double", "float", "boolean"):
            found.append((column.name, "key is a number or text"))
        if kind in ("date", "timestamp_ntz") and column.name.endswith("_key"):
            found.append((column.name, "date key is YYYYMMDD text"))
    return found


def naming_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Naming warnings with the number of values that sit under each name."""
    reports = []
    for relation, df in tables.items():
        rows = [
            F.struct(
                F.lit(relation).alias("relation"),
                F.lit(column).alias("column_name"),
                F.lit(rule).alias("rule"),
                F.count(F.col(f"`{column}`")).alias("value_count"),
            )
            for column, rule in naming(df, relation)
        ]
        if rows:
            reports.append(df.agg(F.array(*rows).alias("found")).select(F.inline("found")))
    if not reports:
        spark = next(iter(tables.values())).sparkSession
        schema = "relation string, column_name string, rule string, value_count bigint"
        return spark.createDataFrame([], schema)
    return _union(reports)
