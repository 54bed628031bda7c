"""Layered tables: routing of models to datasets, and the write dispositions.

A table is a folder of plain Parquet files, partitioned or not, and a small file beside it that
says which folder is in force, with which columns and partitions (a column that older files lack is
NULL there, and a partition's type isn't guessed from its name). Replacing writes a new folder and
then the small file, so the input may read the table and a job that dies changes nothing. Appending
and merging are Spark's own append and dynamic partition overwrite of the folder in force, which
move files in place when the job is committed; a merge may be repeated if the driver died during
that. One writer per table at a time.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.lookup import fits_broadcast
from starloom.operators.merge import join_keys, latest_per_key, merge_on_key
from starloom.sources import hadoop
from starloom.sources.workspace import CODEC, shuffles_freed

# Layer and materialisation of each model folder.
FOLDER_ROUTES: dict[str, tuple[str, str]] = {
    "staging": ("stg", "view"),
    "analytics": ("dwh", "table"),
    "role_playing": ("dwh", "view"),
    "marts": ("mart", "table"),
}

# Analytics models that are role-playing views.
ROLE_PLAYING = ("dim_contact_person", "dim_picked_by_person", "dim_salesperson_person")


@dataclass(frozen=True)
class Route:
    """A model's layer and whether it is kept as a table or recomputed as a view."""

    layer: str
    materialized: str


def folder_of(model: str) -> str:
    if model in ROLE_PLAYING:
        return "role_playing"
    if model.startswith("mart_"):
        return "marts"
    if model.startswith(("dim_", "fact_")):
        return "analytics"
    return "staging"


def route(model: str, overrides: Mapping[str, Mapping[str, str]] | None = None) -> Route:
    """A model's own setting (``schema``, ``materialized``) beats its folder's."""
    layer, materialized = FOLDER_ROUTES[folder_of(model)]
    own = (overrides or {}).get(model, {})
    return Route(own.get("schema", layer), own.get("materialized", materialized))


@dataclass(frozen=True)
class Table:
    """What is in force of a table."""

    schema: str
    partition_by: list[str]
    folder: str

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.dataType, True) for c in schema.fields])


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The table's columns and those that only the new rows have, in this order.

    A column of both must have one type: a change of type is refused.
    """
    had = {c.name.lower(): c for c in old.fields}
    for c in new.fields:
        before = had.get(c.name.lower())
        if before is not None and before.dataType != c.dataType:
            raise ValueError(
                f"column {c.name} is {before.dataType.simpleString()} in the table and"
                f" {c.dataType.simpleString()} in the rows to add"
            )
    return T.StructType([*old.fields, *[c for c in new.fields if c.name.lower() not in had]])


# Characters that a partition's folder name spells as % and two digits.
_SPELLED = "\"#%'*/:=?\\\x7f{[]^" + "".join(map(chr, range(1, 32)))


def _folder_name(column: str) -> Column:
    """The folder of a partition value, as Spark's writer names it."""
    value = F.col(column).cast("string")
    for char in sorted(_SPELLED, key=lambda c: c != "%"):
        value = F.replace(value, F.lit(char), F.lit(f"%{ord(char):02X}"))
    named = F.when(value == "", None).otherwise(value)
    return F.concat(F.lit(f"{column}="), F.coalesce(named, F.lit("__HIVE_DEFAULT_PARTITION__")))


class LayerStore:
    """Tables under ``root/<prefix>_<layer>/<table>``."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "sales"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def dataset(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def location(self, layer: str, table: str) -> str:
        return f"{self.root}/{self.dataset(layer)}/{table}"

    def _entry(self, layer: str, table: str) -> str:
        return f"{self.location(layer, table)}/table.json"

    def exists(self, layer: str, table: str) -> bool:
        return hadoop.exists(self.spark, self._entry(layer, table))

    def entry(self, layer: str, table: str) -> Table:
        if not self.exists(layer, table):
            raise FileNotFoundError(f"no table {self.dataset(layer)}.{table} under {self.root}")
        return Table(**json.loads(hadoop.read_text(self.spark, self._entry(layer, table))))

    def _put(self, layer: str, table: str, entry: Table) -> None:
        hadoop.write_text(self.spark, self._entry(layer, table), json.dumps(asdict(entry)))

    def folder(self, layer: str, table: str, entry: Table) -> str:
        return f"{self.location(layer, table)}/{entry.folder}"

    def read(self, layer: str, table: str) -> DataFrame:
        entry = self.entry(layer, table)
        reader = self.spark.read.schema(entry.columns)
        return reader.parquet(self.folder(layer, table, entry)).select(*entry.columns.names)

    def replace(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write the table anew; the input may read the present one."""
        return self.replace_parts([df], layer, table, partition_by)

    def replace_parts(
        self,
        parts: Sequence[DataFrame],
        layer: str,
        table: str,
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """Write the table anew from frames of the same columns, one after the other.

        Each one's shuffles are gone when the next begins. The table is in force when all
        are written.
        """
        first = parts[0]
        entry = Table(nullable(first.schema).json(), list(partition_by), f"data-{uuid.uuid4().hex}")
        with shuffles_freed(self.spark):
            for df in parts:
                writer = df.write.mode("append").option("compression", CODEC)
                writer.partitionBy(*partition_by).parquet(self.folder(layer, table, entry))
        self._put(layer, table, entry)
        return self.read(layer, table)

    def prune(self, layer: str, table: str) -> int:
        """Delete the folders no longer in force, and count them; no query may read them more."""
        location, held = self.location(layer, table), self.entry(layer, table).folder
        names = hadoop.child_names(self.spark, location)
        old = [name for name in names if name.startswith("data-") and name != held]
        for name in old:
            hadoop.delete_folder(self.spark, f"{location}/{name}")
        return len(old)

    def _widen(self, layer: str, table: str, new: T.StructType) -> Table:
        """Add columns to the table first: files that lack them, or have more, can be read."""
        entry = self.entry(layer, table)
        schema = widened(entry.columns, nullable(new))
        if schema != entry.columns:
            entry = Table(schema.json(), entry.partition_by, entry.folder)
            self._put(layer, table, entry)
        return entry

    def append(self, df: DataFrame, layer: str, table: str) -> DataFrame:
        """Add rows to the table, or start it.

        The table's partitions stay. Columns that are new to it are added, and are
        NULL in its older rows; columns that the new rows lack are NULL in them.
        """
        if not self.exists(layer, table):
            return self.replace(df, layer, table)
        entry = self._widen(layer, table, df.schema)
        writer = df.write.mode("append").partitionBy(*entry.partition_by)
        writer.parquet(self.folder(layer, table, entry))
        return self.read(layer, table)

    def merge(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        keys: Sequence[str],
        order_by: Sequence[str] = (),
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """Update rows whose key is in ``df`` and insert the others.

        The newest row of each key is staged first: the merge reads it several
        times, and the source should be read once. Staged files are deleted after.
        ``partition_by`` counts where the merge starts the table.
        """
        newest = self.stage(latest_per_key(df, keys, order_by), table)
        merged = self.merge_newest(newest, layer, table, keys, partition_by)
        self.unstage(newest)
        return merged

    def merge_newest(
        self,
        newest: DataFrame,
        layer: str,
        table: str,
        keys: Sequence[str],
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """Merge staged rows that hold each key once; NULL is a key like any other.

        Of a partitioned table only partitions that hold a changed key, or get one,
        are read and overwritten; they are found by a scan of the keys and partition
        columns. A table without partitions is written anew.
        """
        if not self.exists(layer, table):
            return self.replace(newest, layer, table, partition_by)
        entry = self._widen(layer, table, newest.schema)
        changed = newest.select(*keys)
        if fits_broadcast(changed):
            changed = F.broadcast(changed)
        target = self.read(layer, table)
        places = entry.partition_by
        if not places:
            return self.replace(merge_on_key(target, newest, keys, changed), layer, table)
        touched = self.stage(self._touched(target, newest, keys, changed, places), table)
        rewritten = target.join(
            F.broadcast(touched.toDF(*[f"__at_{c}" for c in places])),
            join_keys(places, [f"__at_{c}" for c in places]),
            "left_semi",
        )
        merged = merge_on_key(rewritten, newest, keys, changed).select(*entry.columns.names)
        folder = self.folder(layer, table, entry)
        emptied = self._emptied(merged, touched, places)
        (
            # Large partitions are split and small ones put together.
            merged.hint("rebalance", *places)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*places)
            .parquet(folder)
        )
        for name in emptied:
            hadoop.delete_folder(self.spark, f"{folder}/{name}")
        self.unstage(touched)
        return self.read(layer, table)

    def _touched(self, target, newest, keys, changed: DataFrame, places: Sequence[str]) -> DataFrame:
        """The partitions that a changed key is in or goes to, a row each."""
        source = target.select(*places, *[F.col(k).alias(f"__old_{k}") for k in keys])
        had = source.join(changed, join_keys([f"__old_{k}" for k in keys], keys), "left_semi")
        return had.select(*places).union(newest.select(*places)).distinct()

    def _emptied(self, merged: DataFrame, touched: DataFrame, places: Sequence[str]) -> list[str]:
        """Folders of partitions all of whose rows have moved to others.

        An overwrite by partition has no row to tell of these. They are partitions of
        changed keys, and known by their values.
        """
        there = merged.select(*[F.col(c).alias(f"__in_{c}") for c in places]).distinct()
        gone = touched.join(there, join_keys(places, there.columns), "left_anti")
        path = F.concat_ws("/", *[_folder_name(c) for c in places])
        return [row["path"] for row in gone.select(path.alias("path")).collect()]

    def stage(self, df: DataFrame, table: str, load_id: str | None = None) -> DataFrame:
        """Write staged files beside the tables, touching none of them."""
        path = f"{self.root}/staging_files/{load_id or uuid.uuid4().hex}/{table}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def unstage(self, staged: DataFrame) -> None:
        """Delete the files of a staged frame that nothing reads any more."""
        for folder in {name.rsplit("/", 1)[0] for name in staged.inputFiles()}:
            if "/staging_files/" in folder:
                hadoop.delete_folder(self.spark, folder)

    def materialize(
        self,
        df: DataFrame | Sequence[DataFrame],
        model: str,
        overrides=None,
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """Persist a model routed to a table; hand back a view's lazy plan as it is.

        A model may come in parts, which are written one after the other.
        """
        parts = [df] if isinstance(df, DataFrame) else df
        chosen = route(model, overrides)
        if chosen.materialized == "view":
            return functools.reduce(DataFrame.unionByName, parts)
        return self.replace_parts(parts, chosen.layer, model, partition_by)
