"""Building the whole warehouse: staging views, analytics tables, the mart."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame

from starloom.functions.calendar import dim_date
from starloom.operators.lookup import JoinLimits
from starloom.plans import integration, roles
from starloom.plans.mart import mart_parts
from starloom.plans.staging import StagingViews
from starloom.sources.layers import LayerStore
from starloom.sources.workspace import shuffles_freed

# Independent tables written at a time; Spark shares the cluster among them.
WRITERS = 4


def analytics_models(
    stg: Mapping[str, DataFrame], store: LayerStore, limits: JoinLimits
) -> dict[str, Callable[[], DataFrame | list[DataFrame]]]:
    return {
        "fact_sales_order_line": lambda: integration.fact_parts(stg, limits),
        "dim_customer": lambda: integration.dim_customer(stg, limits),
        "dim_person": lambda: integration.dim_person(stg),
        "dim_stock_item": lambda: integration.dim_stock_item(stg, limits),
        "dim_package_type": lambda: integration.dim_package_type(stg),
        "dim_date": lambda: dim_date(store.spark),
    }


def build_analytics(
    raw: Mapping[str, DataFrame],
    store: LayerStore,
    loaded_at: Column | None = None,
    limits: JoinLimits = JoinLimits(),
) -> dict[str, DataFrame]:
    """Write the five dimensions and the fact and return them as read back."""
    models = analytics_models(StagingViews(raw, loaded_at), store, limits)
    with shuffles_freed(store.spark), ThreadPoolExecutor(WRITERS) as pool:
        written = pool.map(lambda name: store.materialize(models[name](), name), models)
        return dict(zip(models, written, strict=True))


def role_views(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "dim_contact_person": roles.dim_contact_person(tables["dim_person"]),
        "dim_picked_by_person": roles.dim_picked_by_person(tables["dim_person"]),
        "dim_salesperson_person": roles.dim_salesperson_person(tables["dim_person"]),
    }


def build_mart(
    tables: Mapping[str, DataFrame],
    store: LayerStore,
    limits: JoinLimits = JoinLimits(),
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write the mart from the written tables.

    ``partition_by`` (say, the order's fiscal year) lets reports that filter on
    those columns skip the rest of the mart.
    """
    with shuffles_freed(store.spark):
        parts = mart_parts(tables, limits)
        return store.materialize(parts, "mart_sales_order_line", partition_by=partition_by)


def build_warehouse(
    raw: Mapping[str, DataFrame],
    store: LayerStore,
    loaded_at: Column | None = None,
    limits: JoinLimits = JoinLimits(),
    mart_partition_by: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """All published relations: tables read back, role-playing views lazy."""
    tables = build_analytics(raw, store, loaded_at, limits)
    mart = build_mart(tables, store, limits, mart_partition_by)
    return tables | role_views(tables) | {"mart_sales_order_line": mart}
