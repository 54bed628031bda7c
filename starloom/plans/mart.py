"""The wide order-line mart: the fact joined to every dimension it points at."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame

from starloom.functions.columns import filtered_columns, interleaved, prefixed
from starloom.operators.lookup import JoinLimits, Lookup, broadcast_bytes, left_lookups, lookup_parts
from starloom.sources.workspace import CODEC, new_workspace

# Columns the mart leaves out. salesperson_key stays in, as in the
# mart being matched.
FACT_EXCLUDED = (
    "customer_key",
    "picked_by_person_key",
    "contact_person_key",
    "stock_item_key",
    "package_type_key",
    "order_date_key",
    "expected_delivery_date_key",
    "sales_order_picking_completed_date_key",
    "sales_order_line_picking_completed_date_key",
)
CUSTOMER_EXCLUDED = (
    "customer_key",
    "bill_to_customer_key",
    "buying_group_key",
    "delivery_city_key",
    "postal_city_key",
)
DATE_EXCLUDED = ("date_key",)

# Person roles, stock item columns and package type column.
PERSON_ROLES = {
    "salesperson_key": "salesperson_person_full_name",
    "picked_by_person_key": "picked_by_person_person_full_name",
    "contact_person_key": "contact_person_person_full_name",
}
STOCK_ITEM_TAKEN = ("stock_item_name", "color_name", "supplier_name", "is_chiller_stock")
PACKAGE_TYPE_TAKEN = {"package_type_name": "package_type_package_type_name"}

# Calendar roles with all attributes, and with the date alone.
FULL_DATE_ROLES = ("order_date", "expected_delivery_date")
SHORT_DATE_ROLES = (
    "sales_order_picking_completed_date",
    "sales_order_line_picking_completed_date",
)


def customer_with_bill_to(
    dim_customer: DataFrame, limits: JoinLimits = JoinLimits(), size: str = "measured"
) -> DataFrame:
    """Customers with the name of the customer that pays for them.

    Reached through the customer, so it is resolved here, once per customer,
    instead of once per order line. ``size`` is what is known of the customers.
    """
    payer = Lookup(
        dim_customer,
        "bill_to_customer_key",
        "customer_key",
        {"customer_name": "bill_to_customer_name"},
        size,
    )
    return left_lookups(dim_customer, [payer], ["customer_key"], limits)


def person_lookups(dim_person: DataFrame) -> list[Lookup]:
    return [
        Lookup(dim_person, key, "person_key", {"person_full_name": name})
        for key, name in PERSON_ROLES.items()
    ]


def date_lookups(dim_date: DataFrame) -> list[Lookup]:
    """The calendar under its four roles; its size is fixed by its two end days."""
    attributes = filtered_columns(dim_date, DATE_EXCLUDED)
    taken = {role: prefixed(attributes, f"{role}_") for role in FULL_DATE_ROLES}
    taken |= {role: {"full_date": f"{role}_full_date"} for role in SHORT_DATE_ROLES}
    return [
        Lookup(dim_date, f"{role}_key", "date_key", take, size="bounded")
        for role, take in taken.items()
    ]


def mart_columns(tables: Mapping[str, DataFrame]) -> list[str]:
    """Output columns, in order, computed from the tables' own columns."""
    customer = filtered_columns(tables["dim_customer"], CUSTOMER_EXCLUDED)
    dates = filtered_columns(tables["dim_date"], DATE_EXCLUDED)
    return [
        *filtered_columns(tables["fact_sales_order_line"], FACT_EXCLUDED),
        *prefixed(customer, "customer_").values(),
        "bill_to_customer_name",
        *PERSON_ROLES.values(),
        *STOCK_ITEM_TAKEN,
        *PACKAGE_TYPE_TAKEN.values(),
        *interleaved(dates, [f"{role}_" for role in FULL_DATE_ROLES]),
        *[f"{role}_full_date" for role in SHORT_DATE_ROLES],
    ]


def mart_sales_order_line(
    tables: Mapping[str, DataFrame], limits: JoinLimits = JoinLimits()
) -> DataFrame:
    """One row per order line with all its dimension attributes, 72 columns."""
    return mart_parts(tables, replace(limits, parts=0))[0]


def mart_parts(
    tables: Mapping[str, DataFrame], limits: JoinLimits = JoinLimits()
) -> list[DataFrame]:
    """The mart in parts, see :func:`lookup_parts`; by customer, where customers are shuffled.

    ``tables`` are the written dimensions and fact: read lazily from staging, the
    customer dimension alone would be worked out twice.
    """
    # The whole customer is measured, once: the payer's name doubles its bytes at most, and
    # is no reason to join a large dimension to find out.
    size = broadcast_bytes(tables["dim_customer"], limits)
    known = "measured" if size is None else "bounded"
    customers = customer_with_bill_to(tables["dim_customer"], limits, known)
    if size is None and limits.parts:
        # Joined once, not once per part.
        path = f"{new_workspace(customers.sparkSession)}/customers"
        customers.write.option("compression", CODEC).parquet(path)
        customers = customers.sparkSession.read.schema(customers.schema).parquet(path)
    left = limits if size is None else replace(limits, plan_bytes=limits.plan_bytes - 2 * size)
    attributes = filtered_columns(tables["dim_customer"], CUSTOMER_EXCLUDED)
    customer = prefixed(attributes, "customer_") | {
        "bill_to_customer_name": "bill_to_customer_name"
    }
    lookups = [
        *person_lookups(tables["dim_person"]),
        Lookup(
            tables["dim_stock_item"],
            "stock_item_key",
            "stock_item_key",
            {name: name for name in STOCK_ITEM_TAKEN},
        ),
        Lookup(
            customers, "customer_key", "customer_key", customer, "large" if size is None else known
        ),
        Lookup(
            tables["dim_package_type"], "package_type_key", "package_type_key", PACKAGE_TYPE_TAKEN
        ),
        *date_lookups(tables["dim_date"]),
    ]
    parts = lookup_parts(
        tables["fact_sales_order_line"], lookups, ["sales_order_line_key"], left
    )
    return [joined.select(*mart_columns(tables)) for joined in parts]
