"""Left-join lookups that hold up when a dimension or one key grows large.

A dimension is broadcast only after its row count and its bytes have been
measured and found small. If it is large but few of its keys are in use (ten
salespeople out of a billion persons), the rows in use are set aside first and
measured in its place. Every other one is joined by a shuffle on its key, and
there the rows of hot keys and of NULL keys are spread: a hot key's rows get a
salt from a hash of the row, and the few dimension rows of those keys are
repeated once per salt. Salting changes where rows go, never which rows come out.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.workspace import new_workspace

SLICES = 4
MEASURED_AT_A_TIME = 4
ROWS_PER_FILE = 500_000
# What a frequent-items sketch may hold, a limit of the sketch itself.
SKETCH_ITEMS = 1_000_000
_SALT = "__salt"


@dataclass(frozen=True)
class JoinLimits:
    """When a dimension may be broadcast, and from what share on a key is hot."""

    broadcast_rows: int = 2_000_000
    broadcast_bytes: int = 64 << 20
    plan_bytes: int = 256 << 20  # all dimensions that one plan broadcasts
    hot_share: float | None = None  # default: one average shuffle partition
    parts: int = 2  # of a table written in parts, for one shuffled lookup
    part_rows: int = 1_000_000  # at least


@dataclass(frozen=True)
class Lookup:
    """Attributes to take from ``dim`` where its ``dim_key`` equals ``key``.

    ``take`` maps dimension columns to output names. ``size`` says what is known
    of the dimension: ``bounded`` by its construction (a generated calendar),
    ``large`` as it grows with the rows that look it up, or else ``measured``.
    """

    dim: DataFrame
    key: str
    dim_key: str
    take: dict[str, str] = field(default_factory=dict)
    size: str = "measured"

    def columns(self) -> list[str]:
        return list(dict.fromkeys([self.dim_key, *self.take]))


def _value_bytes(column: T.StructField) -> Column | None:
    """Bytes of a value of no fixed size."""
    value = F.col(f"`{column.name}`")
    if isinstance(column.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(column.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
    return None


def broadcast_bytes(dim: DataFrame, limits: JoinLimits = JoinLimits()) -> int | None:
    """Bytes of ``dim`` if it may be broadcast: rows are counted first, then measured."""
    if limits.broadcast_rows <= 0:
        return None
    rows = dim.count()
    if rows > limits.broadcast_rows:
        return None
    found = [size for size in map(_value_bytes, dim.schema.fields) if size is not None]
    of_values = 0
    if found:
        total = functools.reduce(add, [size.cast("long") for size in found])
        of_values = dim.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0]
    size = of_values + rows * 16 * (len(dim.columns) + 1)
    return size if size <= limits.broadcast_bytes else None


def fits_broadcast(dim: DataFrame, limits: JoinLimits = JoinLimits()) -> bool:
    return broadcast_bytes(dim, limits) is not None


def near_dims(lookups: Sequence[Lookup], limits: JoinLimits = JoinLimits()) -> set[int]:
    """``id`` of each dimension small enough to broadcast, measured once per dimension.

    The smallest come first, as long as all of them together stay within the plan's bound.
    """
    near = {id(lookup.dim) for lookup in lookups if lookup.size == "bounded"}
    dims: dict[int, DataFrame] = {}
    needed: dict[int, dict[str, None]] = {}
    uses: Counter[int] = Counter()
    for lookup in lookups:
        if lookup.size == "measured":
            dims[id(lookup.dim)] = lookup.dim
            needed.setdefault(id(lookup.dim), {}).update(dict.fromkeys(lookup.columns()))
            uses[id(lookup.dim)] += 1
    with ThreadPoolExecutor(MEASURED_AT_A_TIME) as pool:
        found = pool.map(lambda n: broadcast_bytes(dims[n].select(*needed[n]), limits), dims)
        sizes = {n: size * uses[n] for n, size in zip(dims, found, strict=True) if size is not None}
    left = limits.plan_bytes
    for number in sorted(sizes, key=sizes.get):
        left -= sizes[number]
        if left >= 0:
            near.add(number)
    return near


def few_used(
    df: DataFrame, lookups: Sequence[Lookup], limits: JoinLimits
) -> dict[int, Lookup]:
    """The lookups of which ``df`` uses few keys, each reduced to the rows in use.

    The result is by ``id`` of the lookup that a reduced one stands for.

    Distinct keys are estimated first, for all lookups in one pass. Where they are
    few, the keys are written to the shared folder, so that they are found once,
    measured as they are, and survive a lost executor; so are the rows, after they
    have been counted, since a dimension may repeat its keys.
    """
    if not lookups or limits.broadcast_rows <= 0:
        return {}
    keys = list(dict.fromkeys(lookup.key for lookup in lookups))
    counts = df.agg(*[F.approx_count_distinct(key).alias(key) for key in keys]).first()
    reduced = {}
    for lookup in lookups:
        if counts[lookup.key] > limits.broadcast_rows:
            continue
        # With a row to each key, and the estimate a tenth too high, are the rows too many
        # bytes at their least? Then the keys aren't sent through the driver to find out.
        if 0.9 * counts[lookup.key] * 16 * (len(lookup.columns()) + 1) > limits.broadcast_bytes:
            continue
        folder = new_workspace(df.sparkSession)
        used = df.select(F.col(lookup.key).alias("__used")).distinct()
        used = _written(used, f"{folder}/keys", counts[lookup.key])
        if not fits_broadcast(used, limits):
            continue
        in_use = F.col(lookup.dim_key) == F.col("__used")
        rows = lookup.dim.select(*lookup.columns()).join(F.broadcast(used), in_use, "left_semi")
        found = rows.count()
        if found > limits.broadcast_rows:
            continue
        rows = _written(rows, f"{folder}/rows", found)
        if fits_broadcast(rows, limits):
            reduced[id(lookup)] = replace(lookup, dim=rows)
    return reduced


def _written(df: DataFrame, path: str, rows: int) -> DataFrame:
    """Few rows out of a large scan, gathered into as many files as they need."""
    df.repartition(max(1, math.ceil(rows / ROWS_PER_FILE))).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_keys(
    df: DataFrame, keys: Sequence[str], limits: JoinLimits = JoinLimits()
) -> dict[str, DataFrame]:
    """Of each key column, the keys that hold more than an average partition.

    A written table (hot key, salts) per column that has any. Each salt gets a quarter
    of an average partition, so that two of them in one partition do no harm; all hot
    keys together need at most four salts per partition, which bounds the dimension
    rows that are repeated. As many keys can be hot as there are partitions, and all
    that are found are in the table, which stays with the executors.

    Frequent items of all columns, and the rows, are found in one pass, by a sketch per
    group of input partitions, so that neither all keys are shuffled nor one task merges
    the sketches of a very large scan. NULL counts as a key.
    """
    if not keys:
        return {}
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = limits.hot_share or 1 / partitions
    most = min(math.ceil(1 / share), SKETCH_ITEMS // 8)
    group = F.pmod(F.spark_partition_id(), F.lit(partitions))
    sketches = [
        F.expr(f"approx_top_k(`{key}`, {most}, {max(8 * most, 1024)})").alias(f"top_{number}")
        for number, key in enumerate(keys)
    ]
    folder = new_workspace(df.sparkSession)
    found = (
        df.select(*[F.col(f"`{key}`") for key in keys], group.alias("__group"))
        .groupBy("__group")
        .agg(*sketches, F.count(F.lit(1)).alias("rows"))
    )
    found = _written(found, f"{folder}/sketches", partitions)
    hot_rows = max((found.agg(F.sum("rows")).first()[0] or 0) * share, 1)
    tables = {}
    for number, key in enumerate(keys):
        hot = (
            found.select(F.inline(f"top_{number}"))
            .groupBy(F.col("item").alias("__hot_key"))
            .agg(F.sum("count").alias("rows"))
            .filter(F.col("rows") > hot_rows)
            .select(
                "__hot_key",
                F.ceil(SLICES * F.col("rows") / F.lit(float(hot_rows))).cast("long").alias("__salts"),
            )
        )
        hot = _written(hot, f"{folder}/hot_{number}", most)
        if not hot.isEmpty():
            tables[key] = hot
    return tables


# Types whose equal values have one hash, so that both sides of a join fall into one part.
_ONE_HASH = (
    T.ByteType(),
    T.ShortType(),
    T.IntegerType(),
    T.LongType(),
    T.DateType(),
    T.TimestampType(),
    T.StringType(),
)


@dataclass(frozen=True)
class Part:
    """One part of the rows, by the hash of a lookup's key."""

    number: int
    of: int
    by: Lookup

    def of_key(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.of)) == self.number

    def rows(self, df: DataFrame, hot: DataFrame | None, spread_by: Sequence[str]) -> DataFrame:
        """The part's rows; those of hot keys are dealt out one by one."""
        if hot is None:
            return df.filter(self.of_key(self.by.key))
        one_by_one = F.pmod(F.xxhash64(F.lit("part"), *spread_by), F.lit(self.of)) == self.number
        marked = df.join(hot, F.col(self.by.key).eqNullSafe(F.col("__hot_key")), "left")
        mine = F.when(F.col("__salts").isNull(), self.of_key(self.by.key)).otherwise(one_by_one)
        return marked.filter(mine).drop("__hot_key", "__salts")

    def dim_rows(self, lookup: Lookup, df: DataFrame, dim: DataFrame, kept: Column) -> DataFrame:
        """The rows of ``dim`` that the part's rows can find, those ``kept`` among them."""
        kinds = df.schema[self.by.key].dataType, dim.schema["__dim_key"].dataType
        if lookup is not self.by or kinds[0] != kinds[1] or kinds[0] not in _ONE_HASH:
            return dim
        return dim.filter(self.of_key("__dim_key") | kept)


def salted_left_join(
    df: DataFrame,
    lookup: Lookup,
    hot: DataFrame | None,
    spread_by: Sequence[str],
    limits: JoinLimits = JoinLimits(),
    part: Part | None = None,
) -> DataFrame:
    """Left join by shuffle, the rows of ``hot`` keys spread over their salts.

    With a ``part`` given, ``df`` holds the rows of that part only.
    """
    dim = lookup.dim.select(
        F.col(lookup.dim_key).alias("__dim_key"),
        *[F.col(name).alias(f"__take_{name}") for name in lookup.take],
    )
    if lookup.size == "large":
        # Also where a file looks small: the rows looked up are spread by their
        # key, and so is everything built on them.
        dim = dim.hint("merge")
    taken = [F.col(f"__take_{name}").alias(out) for name, out in lookup.take.items()]
    kept = [F.col(f"`{name}`") for name in df.columns]
    if hot is None:
        if part:
            dim = part.dim_rows(lookup, df, dim, F.lit(False))
        return df.join(dim, F.col(lookup.key) == F.col("__dim_key"), "left").select(*kept, *taken)

    hot_table = _near_if_small(hot, limits)
    salted = (
        df.join(hot_table, F.col(lookup.key).eqNullSafe(F.col("__hot_key")), "left")
        .withColumn(
            _SALT,
            F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("__salts")), F.lit(0)),
        )
        .drop("__hot_key", "__salts")
    )
    marked = dim.join(hot_table, F.col("__dim_key") == F.col("__hot_key"), "left")
    if part:
        marked = part.dim_rows(lookup, df, marked, F.col("__salts").isNotNull())
    repeated = (
        marked.withColumn(
            "__dim_salt",
            F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__salts", F.lit(1)) - 1)),
        )
        .drop("__hot_key", "__salts")
    )
    if lookup.size == "large":
        repeated = repeated.hint("merge")
    matches = (F.col(lookup.key) == F.col("__dim_key")) & (F.col(_SALT) == F.col("__dim_salt"))
    return salted.join(repeated, matches, "left").select(*kept, *taken)


def _near_if_small(hot: DataFrame, limits: JoinLimits) -> DataFrame:
    """One row per hot key, so no more than shuffle partitions; still, it is measured."""
    hot_limits = replace(limits, broadcast_rows=JoinLimits.broadcast_rows)
    return F.broadcast(hot) if fits_broadcast(hot, hot_limits) else hot


def left_lookups(
    df: DataFrame,
    lookups: Sequence[Lookup],
    spread_by: Sequence[str],
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """Keep every row of ``df`` and add the attributes each lookup takes.

    Every ``key`` is a column of ``df``. Shuffled lookups come first and small
    ones last, so that attributes which need no shuffle are not carried through
    one; the result's columns are in the order given. ``spread_by`` names columns
    that tell rows of one key apart; without any, ``df`` holds each key once and
    no key can be hot.
    """
    return lookup_parts(df, lookups, spread_by, replace(limits, parts=0))[0]


def lookup_parts(
    df: DataFrame,
    lookups: Sequence[Lookup],
    spread_by: Sequence[str],
    limits: JoinLimits = JoinLimits(),
) -> list[DataFrame]:
    """The rows of :func:`left_lookups` in parts, to be written one after the other.

    Where lookups are shuffled, all rows lie in the shuffle files once per such lookup, each
    time wider. In parts only one part's rows do; three lookups take six times the parts of
    one. A part is told by the hash of the widest shuffled lookup's key: this dimension is
    shuffled once in all, and its values lie together in what is written; ``df`` and the other
    dimensions are read once per part.
    """
    small = near_dims(lookups, limits)
    near = [lookup for lookup in lookups if id(lookup.dim) in small]
    far = [lookup for lookup in lookups if id(lookup.dim) not in small]
    if spread_by:
        reduced = few_used(df, [lookup for lookup in far if lookup.size == "measured"], limits)
        near += reduced.values()
        far = [lookup for lookup in far if id(lookup) not in reduced]
    keys = list(dict.fromkeys(lookup.key for lookup in far)) if spread_by else []
    hot = hot_keys(df, keys, limits)

    of = 1
    if far and limits.parts:
        wanted = limits.parts * len(far) * (len(far) + 1) // 2
        of = max(1, min(wanted, df.count() // max(1, limits.part_rows)))
    if of == 1:
        return [_looked_up(df, lookups, near, far, hot, spread_by, limits, None)]
    widest = max(far, key=lambda lookup: (lookup.size == "large", len(lookup.take)))
    parts = [Part(number, of, widest) for number in range(of)]
    return [_looked_up(df, lookups, near, far, hot, spread_by, limits, part) for part in parts]


def _looked_up(
    df: DataFrame,
    lookups: Sequence[Lookup],
    near: Sequence[Lookup],
    far: Sequence[Lookup],
    hot: dict[str, DataFrame],
    spread_by: Sequence[str],
    limits: JoinLimits,
    part: Part | None,
) -> DataFrame:
    result = df
    if part:
        found = hot.get(part.by.key)
        hot_table = None if found is None else _near_if_small(found, limits)
        result = part.rows(df, hot_table, spread_by)
    for lookup in far:
        result = salted_left_join(result, lookup, hot.get(lookup.key), spread_by, limits, part)
    for number, lookup in enumerate(near):
        dim_key = f"__near_key_{number}"
        dim = F.broadcast(
            lookup.dim.select(
                F.col(lookup.dim_key).alias(dim_key),
                *[F.col(name).alias(out) for name, out in lookup.take.items()],
            )
        )
        result = result.join(dim, F.col(lookup.key) == F.col(dim_key), "left").drop(dim_key)
    outputs = [out for lookup in lookups for out in lookup.take.values()]
    return result.select(*[f"`{name}`" for name in df.columns], *outputs)
