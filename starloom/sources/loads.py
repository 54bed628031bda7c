"""Loading many tables in one go, with a report."""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.functions.coercion import TableCallback, TypeRule, adapt_table, adapt_types
from starloom.operators.merge import latest_per_key
from starloom.sources.layers import LayerStore

# Tables loaded at a time; Spark shares the cluster among them.
WRITERS = 4


@dataclass(frozen=True)
class TableLoad:
    """What to load of one table and how."""

    table: str
    disposition: str = "replace"
    keys: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    included_columns: tuple[str, ...] | None = None


@dataclass(frozen=True)
class LoadResult:
    table: str
    disposition: str
    rows: int
    seconds: float


def adapted(
    df: DataFrame, load: TableLoad, callback: TableCallback | None, rule: TypeRule | None
) -> DataFrame:
    """The rows to load after the include-list, the table callback and the type rule."""
    if load.included_columns:
        df = df.select(*load.included_columns)
    if callback:
        df = adapt_table(df, load.table, callback)
    return adapt_types(df, rule) if rule else df


def _load(df: DataFrame, store: LayerStore, layer: str, load: TableLoad) -> int:
    """Write one table by its disposition; returns the rows written or merged."""
    if load.disposition == "merge":
        newest = store.stage(latest_per_key(df, load.keys, load.order_by), load.table)
        rows = newest.count()
        store.merge_newest(newest, layer, load.table, load.keys)
        store.unstage(newest)
        return rows
    counted = Observation()
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if load.disposition == "replace":
        store.replace(observed, layer, load.table)
    elif load.disposition == "append":
        store.append(observed, layer, load.table)
    else:
        raise ValueError(f"unknown disposition {load.disposition!r}")
    return counted.get["rows"]


def run_loads(
    source,
    store: LayerStore,
    loads: Iterable[TableLoad],
    layer: str = "raw",
    callback: TableCallback | None = None,
    rule: TypeRule | None = None,
) -> list[LoadResult]:
    """Load each table, a few at a time; rows are counted while they are written."""
    loads = list(loads)
    if len({load.table for load in loads}) < len(loads):
        raise ValueError("a table may be loaded once per run")

    def run(load: TableLoad) -> LoadResult:
        started = time.monotonic()
        df = adapted(source.read(load.table), load, callback, rule)
        rows = _load(df, store, layer, load)
        return LoadResult(load.table, load.disposition, rows, time.monotonic() - started)

    with ThreadPoolExecutor(WRITERS) as pool:
        return list(pool.map(run, loads))


def load_all(source, store: LayerStore, **settings) -> list[LoadResult]:
    """Every table of the source, replacing what is there."""
    return run_loads(source, store, [TableLoad(table) for table in source.tables()], **settings)


def load_selected(
    source, store: LayerStore, tables: Sequence[str], **settings
) -> list[LoadResult]:
    """The named tables only."""
    return run_loads(source, store, [TableLoad(table) for table in tables], **settings)


def extract_only(
    source, store: LayerStore, tables: Sequence[str], load_id: str
) -> dict[str, DataFrame]:
    """Stage the files of one load without touching any table."""
    return {table: store.stage(source.read(table), table, load_id) for table in tables}


def report_frame(spark: SparkSession, results: Sequence[LoadResult]) -> DataFrame:
    """One row per loaded table."""
    return spark.createDataFrame(
        [(r.table, r.disposition, r.rows, r.seconds) for r in results],
        "table_name string, disposition string, row_count bigint, seconds double",
    )
