"""Keyed merge and type 2 history over plain files."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.lookup import fits_broadcast


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key; ties go to the greatest remaining values.

    The maximum of a struct combines before the shuffle, so a key with very many
    versions sends one row per input partition instead of all of them.
    """
    others = [name for name in df.columns if name not in (*keys, *order_by)]
    newest = F.max(F.struct(*order_by, *others)).alias("newest")
    if not (others or order_by):
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(newest).select(
        *[name if name in keys else F.col(f"newest.{name}").alias(name) for name in df.columns]
    )


def join_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of keys in which NULL equals NULL."""
    return functools.reduce(
        and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)]
    )


def merge_on_key(
    target: DataFrame,
    newest: DataFrame,
    keys: Sequence[str],
    changed: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``newest`` replace the target's rows of the same key or are added.

    ``newest`` holds a key once (:func:`latest_per_key`); NULL is a key like any other.
    ``changed`` are its keys, given apart where they are to be broadcast. A column that
    one of the two lacks is NULL in its rows.
    """
    changed = newest.select(*keys) if changed is None else changed
    renamed = changed.toDF(*[f"__new_{k}" for k in keys])
    on = join_keys(keys, renamed.columns)
    untouched = target.join(renamed, on, "left_anti")
    return untouched.select(*target.columns).unionByName(newest, allowMissingColumns=True)


def _row(alive: Column, **columns: Column) -> Column:
    return F.when(alive, F.struct(*[value.alias(name) for name, value in columns.items()]))


def scd2_merge(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    valid_from: Column,
) -> DataFrame:
    """Bring a type 2 table (``valid_from``, ``valid_to``, ``is_current``) up to date.

    A current row whose tracked columns differ is closed at ``valid_from`` and
    followed by a new one; keys the snapshot lacks stay current; new keys are
    added. Closed rows pass through without a join, and both sides of the join
    hold a key once: of a key that the snapshot repeats the row with the greatest
    tracked values counts. NULL is a key like any other.
    """
    open_until = F.lit(None).cast("timestamp")
    columns = [*keys, *tracked]
    closed = history.filter(~F.col("is_current"))
    old = history.filter("is_current").alias("old")
    new = latest_per_key(snapshot.select(*columns), keys)
    on = join_keys([f"old.{k}" for k in keys], [f"new.{k}" for k in keys])
    had = F.col("old.is_current").isNotNull()
    has = F.col("new.__seen").isNotNull()
    same = functools.reduce(
        and_, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked], F.lit(True)
    )
    changed = had & has & ~same
    joined = old.join(new.withColumn("__seen", F.lit(True)).alias("new"), on, "full")
    before = _row(
        had,
        **{c: F.col(f"old.{c}") for c in columns},
        valid_from=F.col("old.valid_from"),
        valid_to=F.when(changed, valid_from).otherwise(F.col("old.valid_to")),
        is_current=~changed,
    )
    after = _row(
        has & (~had | changed),
        **{c: F.col(f"new.{c}") for c in columns},
        valid_from=valid_from,
        valid_to=open_until,
        is_current=F.lit(True),
    )
    rows = joined.select(F.array_compact(F.array(before, after)).alias("rows"))
    return closed.select(*columns, "valid_from", "valid_to", "is_current").unionByName(
        rows.select(F.inline("rows"))
    )


def scd2_start(
    snapshot: DataFrame,
    columns: Sequence[str],
    valid_from: Column,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """A first history: every row, one per key if ``keys`` are named, current since then."""
    rows = snapshot.select(*columns)
    return (latest_per_key(rows, keys) if keys else rows).select(
        *columns,
        valid_from.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def _neighbour(
    df: DataFrame, keys: Sequence[str], at: str, value: str, name: str, later: bool
) -> DataFrame:
    """Add ``value`` of a key's next earlier (or later) row as ``name``; NULL if there is none.

    A key's rows are put side by side year by year, and then the years' ends, so that no
    task gets all rows of a key that has very many.
    """
    span = f"__year_{name}"
    df = df.withColumn(span, F.year(at))
    in_year = Window.partitionBy(*keys, span).orderBy(at)
    of_years = Window.partitionBy(*keys).orderBy(span)
    beside, end = (F.lead, F.min) if later else (F.lag, F.max)
    ends = df.groupBy(*keys, span).agg(end(F.struct(at, value)).alias("__end"))
    ends = ends.select(
        *[F.col(c).alias(f"__end_{c}") for c in (*keys, span)],
        beside(f"__end.{value}").over(of_years).alias("__beside"),
    )
    inside = df.withColumn(name, beside(value).over(in_year))
    on = join_keys([*keys, span], [f"__end_{c}" for c in (*keys, span)])
    joined = inside.join(ends, on)
    return joined.select(*[c for c in df.columns if c != span], F.coalesce(name, "__beside").alias(name))


def scd2_apply(
    history: DataFrame,
    deliveries: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: str,
    deleted: str | None = None,
) -> DataFrame:
    """Bring versions into a type 2 table by their own dates, in whatever order they come.

    A delivery holds from its ``effective`` time to the next change that is known: it is
    put between existing versions, shortens the one before it, and is dropped if that one
    says the same; so is a later version that it makes say nothing new. Where ``deleted`` is
    true the key ends then (see :func:`missing_keys`). At one time a delivered row counts
    before a delivered end and that before what was known; of several rows the greatest
    tracked values count. NULL is a key like any other; a NULL time is left out. Keys that
    aren't delivered pass through.
    """
    columns = [*keys, *tracked, "valid_from", "valid_to", "is_current"]
    touched = deliveries.select(*[F.col(k).alias(f"__new_{k}") for k in keys]).distinct()
    touched = F.broadcast(touched) if fits_broadcast(touched) else touched
    on = join_keys(keys, touched.columns)
    mine = history.join(touched, on, "left_semi")

    def state(rank: Column, alive: Column, known: bool = True) -> Column:
        values = [
            (F.col(c) if known else F.lit(None).cast(history.schema[c].dataType)).alias(c)
            for c in tracked
        ]
        return F.struct(rank.alias("rank"), alive.alias("alive"), F.struct(*values).alias("values"))

    gone = F.lit(False) if deleted is None else F.coalesce(F.col(deleted), F.lit(False))
    events = (
        mine.select(*keys, F.col("valid_from").alias("__at"), state(F.lit(1), F.lit(True)).alias("__state"))
        .union(
            mine.filter("valid_to is not null").select(
                *keys, F.col("valid_to").alias("__at"), state(F.lit(0), F.lit(False), False).alias("__state")
            )
        )
        .union(
            deliveries.filter(F.col(effective).isNotNull()).select(
                *keys,
                F.col(effective).cast("timestamp").alias("__at"),
                F.when(gone, state(F.lit(2), F.lit(False), False))
                .otherwise(state(F.lit(3), F.lit(True)))
                .alias("__state"),
            )
        )
        .groupBy(*keys, "__at")
        .agg(F.max("__state").alias("__state"))
    )
    said = F.struct("__state.alive", "__state.values").alias("__said")
    events = events.select(*keys, "__at", said)
    before = _neighbour(events, keys, "__at", "__said", "__before", later=False)
    alive, was = F.col("__said.alive"), F.col("__before.alive")
    news = F.when(alive, ~F.col("__said").eqNullSafe(F.col("__before"))).otherwise(
        F.coalesce(was, F.lit(False))
    )
    kept = before.filter(news).select(*keys, "__at", "__said")
    spans = _neighbour(
        kept.withColumn("__time", F.col("__at")), keys, "__at", "__time", "__until", later=True
    )
    versions = spans.filter("__said.alive").select(
        *keys,
        *[F.col(f"__said.values.{c}").alias(c) for c in tracked],
        F.col("__at").alias("valid_from"),
        F.col("__until").alias("valid_to"),
        F.col("__until").isNull().alias("is_current"),
    )
    return history.join(touched, on, "left_anti").select(*columns).unionByName(versions)


def missing_keys(
    history: DataFrame, snapshot: DataFrame, keys: Sequence[str], at: Column
) -> DataFrame:
    """Keys in force at ``at`` that a full snapshot of that time lacks, as deliveries.

    The columns are those of ``history`` for :func:`scd2_apply`, with ``effective`` and a true
    ``deleted``.
    """
    there = snapshot.select(*[F.col(k).alias(f"__had_{k}") for k in keys]).distinct()
    in_force = history.filter(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    )
    gone = in_force.join(there, join_keys(keys, there.columns), "left_anti")
    return gone.withColumns({"effective": at, "deleted": F.lit(True)}).drop(
        "valid_from", "valid_to", "is_current"
    )
