"""Cursor loads: read what is at or after a stored mark, bounded ranges, chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.lookup import fits_broadcast
from starloom.operators.merge import join_keys
from starloom.sources.layers import LayerStore

_STATE_SCHEMA = (
    "resource string, cursor_column string, kind string, last_value string, keys_at string"
)
_STATE_LAYER = "state"


class CursorState:
    """The high-water mark of each resource, one small table per resource."""

    def __init__(self, store: LayerStore):
        self.store = store

    def _row(self, resource: str):
        if not self.store.exists(_STATE_LAYER, resource):
            return None
        return self.store.read(_STATE_LAYER, resource).first()

    def get(self, resource: str) -> str | None:
        row = self._row(resource)
        return row["last_value"] if row else None

    def settled(self, resource: str) -> bool:
        """Whether the digests kept are those of the keys loaded at the mark."""
        row = self._row(resource)
        return row is not None and row["keys_at"] is not None and row["keys_at"] == row["last_value"]

    def set(
        self,
        resource: str,
        cursor: str,
        value: str | None,
        kind: str | None = None,
        keys_at: str | None = None,
    ) -> None:
        """``value`` is a mark as :func:`mark_text` gives it, ``kind`` the cursor's type.

        ``keys_at`` is the mark that the digests kept belong to; None if a load isn't over.
        """
        row = [(resource, cursor, kind, value, keys_at)]
        state = self.store.spark.createDataFrame(row, _STATE_SCHEMA)
        self.store.replace(state.coalesce(1), _STATE_LAYER, resource)
        self.store.prune(_STATE_LAYER, resource)

    def reset(self, resource: str) -> None:
        if self.store.exists(_STATE_LAYER, resource):
            self.set(resource, "", None)

    def seen(self, resource: str) -> DataFrame | None:
        """Digests of the keys loaded at the mark, and of those without a cursor value."""
        name = f"{resource}_keys"
        return self.store.read(_STATE_LAYER, name) if self.store.exists(_STATE_LAYER, name) else None

    def remember(self, resource: str, digests: DataFrame) -> DataFrame:
        return self.store.replace(digests, _STATE_LAYER, f"{resource}_keys")

    def tidy(self, resource: str) -> None:
        self.store.prune(_STATE_LAYER, f"{resource}_keys")


def mark_text(value: Column, kind: T.DataType) -> Column:
    """A cursor value as text that means the same in every session.

    A point in time is kept as microseconds since 1970 in UTC: its text would move
    with the session's time zone.
    """
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    return value.cast("string")


def mark_value(mark: str, kind: T.DataType) -> Column:
    """The cursor value that :func:`mark_text` has written."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(int(mark)))
    return F.lit(mark).cast(kind)


def since(
    df: DataFrame,
    cursor: str,
    start: Column | None,
    end: Column | None = None,
    on_null: str = "raise",
) -> DataFrame:
    """Rows with ``start <= cursor < end``; either bound may be absent.

    ``on_null`` says what a missing cursor value does: ``raise``, ``include`` or
    ``exclude``. The bounds reach the scan in every case.
    """
    value = F.col(cursor)
    within = value.isNotNull()
    if start is not None:
        within = within & (value >= start)
    if end is not None:
        within = within & (value < end)
    if on_null == "exclude":
        return df.filter(within)
    if on_null == "include":
        return df.filter(within | value.isNull())
    if on_null != "raise":
        raise ValueError(f"on_null must be raise, include or exclude, not {on_null!r}")
    missing = F.raise_error(F.lit(f"cursor column {cursor} is NULL"))
    checked = F.coalesce(value, missing.cast(df.schema[cursor].dataType))
    return df.filter(within | value.isNull()).withColumn(cursor, checked)


def newest_first(df: DataFrame, cursor: str, key: str) -> DataFrame:
    """Descending by cursor, the key breaking ties so equal cursors still spread."""
    return df.orderBy(F.col(cursor).desc(), F.col(key))


def first_chunks(df: DataFrame, order: Sequence[Column], chunk_size: int, chunks: int = 1):
    """The first ``chunks`` chunks in the given order (a top-k, no full sort)."""
    return df.orderBy(*order).limit(chunk_size * chunks)


def years_back(now: Column, years: int = 1) -> Column:
    """A bound relative to ``now``."""
    return now - F.make_interval(years=F.lit(years))


def load_stamp(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add ``processed_at``, one constant per run."""
    return df.withColumn("processed_at", F.current_timestamp() if at is None else at)


def key_digest(keys: Sequence[str]) -> Column:
    """A key in 32 characters; NULL in a key is a value like any other."""
    return F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))


def _unseen(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    seen = seen.select(F.col("digest").alias("__digest"))
    seen = F.broadcast(seen) if fits_broadcast(seen) else seen
    return df.join(seen, key_digest(keys) == F.col("__digest"), "left_anti")


def cursor_load(
    source: DataFrame,
    store: LayerStore,
    layer: str,
    table: str,
    cursor: str,
    keys: Sequence[str],
    disposition: str = "append",
    initial: object | None = None,
    on_null: str = "raise",
) -> DataFrame:
    """Load what is new in ``source`` and move the mark to the greatest cursor seen.

    Rows equal to the mark are read again, since more of them may have come. An
    append leaves out keys it has loaded at the mark or with a missing cursor: the
    state keeps their digests, so the table isn't read. Rows that come while a load
    runs are left to the next one: the new mark and the keys at it are settled
    first. Only a run after one that failed before its mark was written, or after
    someone else filled the table, looks its keys up in the table. A merge needs
    none of this. NULL is a key like any other.
    """
    state, resource = CursorState(store), f"{table}_cursor"
    kind = source.schema[cursor].dataType
    mark = state.get(resource)
    bound = None if initial is None else F.lit(initial).cast(kind)
    if mark is not None:
        bound = mark_value(mark, kind)
    fresh = since(source, cursor, bound, on_null=on_null)
    if disposition == "append":
        return _cursor_append(fresh, state, resource, layer, table, cursor, keys, mark, bound)
    seen = Observation()
    observed = fresh.observe(seen, mark_text(F.max(cursor), kind).alias("last"))
    if disposition == "merge":
        result = store.merge(observed, layer, table, keys, [cursor])
    elif disposition == "replace":
        result = store.replace(observed, layer, table)
    else:
        raise ValueError(f"unknown disposition {disposition!r}")
    last = seen.get["last"]
    if last is not None:
        # No digests: an append that follows looks its keys up in the table.
        state.set(resource, cursor, last, kind.simpleString())
    return result


def _cursor_append(fresh, state, resource, layer, table, cursor, keys, mark, bound) -> DataFrame:
    store, kind = state.store, fresh.schema[cursor].dataType
    known = store.exists(layer, table)
    seen = state.seen(resource) if state.settled(resource) and mark is not None else None
    last = fresh.agg(mark_text(F.max(cursor), kind).alias("last")).first()["last"]
    value, missing = F.col(cursor), F.col(cursor).isNull()
    last = mark if last is None else last
    at_last = missing if last is None else missing | (value == mark_value(last, kind))
    digests = fresh.filter(at_last).select(key_digest(keys).alias("digest"), missing.alias("missing"))
    # Kept from the state: keys without a cursor value, and at a mark that has not moved.
    if seen is not None:
        digests = digests.unionByName(seen if last == mark else seen.filter("missing"))
    state.set(resource, cursor, mark, kind.simpleString())
    boundary = state.remember(resource, digests.distinct())

    settled = boundary.select(F.col("digest").alias("__digest")).distinct()
    settled = F.broadcast(settled) if fits_broadcast(settled) else settled
    edge = fresh.filter(at_last).join(settled, key_digest(keys) == F.col("__digest"), "left_semi")
    inner = fresh.filter(value < mark_value(last, kind)) if last is not None else fresh.limit(0)
    if seen is not None:
        edge = _unseen(edge, seen, keys)
        inner = inner.filter(value > bound).unionByName(_unseen(inner.filter(value == bound), seen, keys))
    rows = inner.unionByName(edge)
    if seen is None and known:
        present = store.read(layer, table)
        if bound is not None:
            present = present.filter((value >= bound) | missing)
        present = present.select(*[F.col(k).alias(f"__had_{k}") for k in keys]).distinct()
        rows = rows.join(present, join_keys(keys, present.columns), "left_anti")
    result = store.append(rows, layer, table)
    state.set(resource, cursor, last, kind.simpleString(), keys_at=last)
    state.tidy(resource)
    return result


def full_refresh(
    source: DataFrame, store: LayerStore, layer: str, table: str, cursor: str, keys: Sequence[str]
) -> DataFrame:
    """Forget the mark and load everything anew."""
    CursorState(store).reset(f"{table}_cursor")
    return cursor_load(source, store, layer, table, cursor, keys, disposition="replace")
