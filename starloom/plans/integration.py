"""Integration: staging views joined into the shape of dimensions and the fact."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.calendar import date_key
from starloom.functions.columns import replace_columns
from starloom.operators.colocated import Colocated, colocated_lookup, store_colocated
from starloom.operators.lookup import JoinLimits, Lookup, left_lookups, lookup_parts

Staging = Mapping[str, DataFrame]

# Output columns of the integration models.
CUSTOMER_COLUMNS = (
    "customer_key",
    "customer_name",
    "bill_to_customer_key",
    "customer_category_name",
    "buying_group_key",
    "buying_group_name",
    "primary_contact_full_name",
    "primary_contact_is_system_user",
    "primary_contact_is_employee",
    "primary_contact_is_salesperson",
    "primary_contact_phone_number",
    "primary_contact_email_address",
    "alternate_contact_full_name",
    "delivery_method_name",
    "delivery_city_key",
    "delivery_city_name",
    "delivery_state_province_name",
    "delivery_state_province_population",
    "delivery_country_name",
    "delivery_country_formal_name",
    "delivery_country_type",
    "delivery_country_population",
    "postal_city_key",
    "credit_limit",
    "standard_discount_percentage",
    "is_on_credit_hold",
    "payment_term_days",
    "phone_number",
    "website_url",
    "delivery_address",
    "delivery_postal_code",
    "delivery_location",
    "postal_address",
    "postal_postal_code",
)
STOCK_ITEM_COLUMNS = (
    "stock_item_key",
    "stock_item_name",
    "supplier_key",
    "color_key",
    "unit_package_type_name",
    "outer_package_type_name",
    "brand",
    "size",
    "lead_time_days",
    "quantiy_per_outer",
    "is_chiller_stock",
    "tax_rate",
    "unit_price",
    "recommended_retail_price",
    "typical_weight_per_unit",
    "color_name",
    "supplier_name",
)
PERSON_COLUMNS = (
    "person_key",
    "person_full_name",
    "person_preferred_name",
    "is_system_user",
    "is_employee",
    "is_salesperson",
    "phone_number",
    "email_address",
)
PACKAGE_TYPE_COLUMNS = ("package_type_key", "package_type_name")

# Order-line columns as the fact names them, then the order's.
LINE_TO_FACT = {
    "order_line_key": "sales_order_line_key",
    "order_key": "sales_order_key",
    "stock_item_key": "stock_item_key",
    "package_type_key": "package_type_key",
    "quantity": "quantity",
    "unit_price": "unit_price",
    "tax_rate": "tax_rate",
    "picked_quantity": "picked_quantity",
    "picking_completed_date_key": "sales_order_line_picking_completed_date_key",
}
ORDER_TO_FACT = {
    "customer_key": "customer_key",
    "salesperson_key": "salesperson_key",
    "picked_by_person_key": "picked_by_person_key",
    "contact_person_key": "contact_person_key",
    "backorder_order_key": "backorder_order_key",
    "order_date_key": "order_date_key",
    "expected_delivery_date_key": "expected_delivery_date_key",
    "is_undersupply_backordered": "is_undersupply_backordered",
    "picking_completed_date_key": "sales_order_picking_completed_date_key",
}
FACT_DATE_KEYS = (
    "sales_order_line_picking_completed_date_key",
    "order_date_key",
    "expected_delivery_date_key",
    "sales_order_picking_completed_date_key",
)


def city_flatten(stg: Staging, limits: JoinLimits = JoinLimits()) -> DataFrame:
    """Cities with the attributes of their province and of its country."""
    provinces = left_lookups(
        stg["stg_application_city"].select("city_key", "city_name", "state_province_key"),
        [
            Lookup(
                stg["stg_application_state_province"],
                "state_province_key",
                "state_province_key",
                {
                    "state_province_name": "state_province_name",
                    "latest_recored_population": "state_province_population",
                    "country_key": "country_key",
                },
            )
        ],
        ["city_key"],
        limits,
    )
    return left_lookups(
        provinces,
        [
            Lookup(
                stg["stg_application_country"],
                "country_key",
                "country_key",
                {
                    "country_name": "country_name",
                    "country_formal_name": "country_formal_name",
                    "country_type": "country_type",
                    "latest_recored_population": "country_population",
                },
            )
        ],
        ["city_key"],
        limits,
    )


def contact_lookups(stg: Staging) -> list[Lookup]:
    """The person lookup under its two roles, primary and alternate contact."""
    people = stg["stg_application_person"]
    flags = ("is_system_user", "is_employee", "is_salesperson")
    attributes = (*flags, "phone_number", "email_address")
    primary = {"person_full_name": "primary_contact_full_name"}
    primary |= {name: f"primary_contact_{name}" for name in attributes}
    return [
        Lookup(people, "primary_contact_person_key", "person_key", primary),
        Lookup(
            people,
            "alternate_contact_person_key",
            "person_key",
            {"person_full_name": "alternate_contact_full_name"},
        ),
    ]


def city_lookup(cities: DataFrame, role: str) -> Lookup:
    """The flattened city under one role, ``delivery`` or ``postal``."""
    attributes = {
        "city_name": f"{role}_city_name",
        "state_province_name": f"{role}_state_province_name",
        "state_province_population": f"{role}_state_province_population",
        "country_name": f"{role}_country_name",
        "country_formal_name": f"{role}_country_formal_name",
        "country_type": f"{role}_country_type",
        "country_population": f"{role}_country_population",
    }
    return Lookup(cities, f"{role}_city_key", "city_key", attributes)


def postal_city_lookup(cities: DataFrame) -> Lookup:
    """No column comes from the postal city, but a repeated city repeats customers.

    A flattened city is repeated where its own, its province's or its country's key is.
    """
    return Lookup(cities, "postal_city_key", "city_key")


def address(role: str):
    """Both address lines; NULL when either is, as SQL concatenation has it."""
    return F.concat(
        F.col(f"{role}_address_line_1"), F.lit(" "), F.col(f"{role}_address_line_2")
    ).alias(f"{role}_address")


def dim_customer(stg: Staging, limits: JoinLimits = JoinLimits()) -> DataFrame:
    """Customers with category, group, contacts, delivery method and delivery city."""
    cities = city_flatten(stg, limits)
    looked_up = left_lookups(
        stg["stg_sales_customer"],
        [
            Lookup(
                stg["stg_sales_customer_category"],
                "customer_category_key",
                "customer_category_key",
                {"customer_category_name": "customer_category_name"},
            ),
            Lookup(
                stg["stg_sales_buying_group"],
                "buying_group_key",
                "buying_group_key",
                {"buying_group_name": "buying_group_name"},
            ),
            *contact_lookups(stg),
            Lookup(
                stg["stg_application_delivery_method"],
                "delivery_method_key",
                "delivery_method_key",
                {"delivery_method_name": "delivery_method_name"},
            ),
            city_lookup(cities, "delivery"),
            postal_city_lookup(cities),
        ],
        ["customer_key"],
        limits,
    )
    return looked_up.select("*", address("delivery"), address("postal")).select(*CUSTOMER_COLUMNS)


def dim_package_type(stg: Staging) -> DataFrame:
    return stg["stg_warehouse_package_type"].select(*PACKAGE_TYPE_COLUMNS)


def dim_person(stg: Staging) -> DataFrame:
    """People without their load stamp."""
    return stg["stg_application_person"].select(*PERSON_COLUMNS)


def package_lookups(stg: Staging) -> list[Lookup]:
    """The package type under its two roles, unit and outer."""
    return [
        Lookup(
            stg["stg_warehouse_package_type"],
            f"{role}_package_type_key",
            "package_type_key",
            {"package_type_name": f"{role}_package_type_name"},
        )
        for role in ("unit", "outer")
    ]


def dim_stock_item(stg: Staging, limits: JoinLimits = JoinLimits()) -> DataFrame:
    """Stock items with package, colour and supplier names."""
    return left_lookups(
        stg["stg_warehouse_stock_item"],
        [
            *package_lookups(stg),
            Lookup(
                stg["stg_warehouse_color"],
                "color_key",
                "color_key",
                {"color_name": "color_name"},
            ),
            Lookup(
                stg["stg_purchasing_supplier"],
                "supplier_key",
                "supplier_key",
                {"supplier_name": "supplier_name"},
            ),
        ],
        ["stock_item_key"],
        limits,
    ).select(*STOCK_ITEM_COLUMNS)


def order_lines_with_orders(stg: Staging, limits: JoinLimits = JoinLimits()) -> DataFrame:
    """Every order line with its order's attributes, dates still dates."""
    return order_lines_in_parts(stg, replace(limits, parts=0))[0]


def order_lines_in_parts(stg: Staging, limits: JoinLimits = JoinLimits()) -> list[DataFrame]:
    """The same in parts, see :func:`lookup_parts`."""
    lines = stg["stg_sales_order_line"].select(
        *[F.col(old).alias(new) for old, new in LINE_TO_FACT.items()],
        F.col("processed_at").alias("sales_order_line_processed_at"),
    )
    orders = stg["stg_sales_order"]
    order = Lookup(orders, "sales_order_key", "order_key", ORDER_TO_FACT, size="large")
    columns = [*LINE_TO_FACT.values(), *ORDER_TO_FACT.values(), "sales_order_line_processed_at"]
    parts = lookup_parts(lines, [order], ["sales_order_line_key"], limits)
    return [joined.select(*columns) for joined in parts]


def stored_by_order(
    stg: Staging, folder: str, buckets: int, limits: JoinLimits = JoinLimits()
) -> Colocated:
    """Order lines and orders written by their order key, to be joined where they lie."""
    lines = stg["stg_sales_order_line"].select(
        *[F.col(old).alias(new) for old, new in LINE_TO_FACT.items()],
        F.col("processed_at").alias("sales_order_line_processed_at"),
    )
    orders = stg["stg_sales_order"].select("order_key", *ORDER_TO_FACT)
    return store_colocated(lines, orders, "sales_order_key", "order_key", folder, buckets, limits)


def stored_lines_with_orders(stored: Colocated, limits: JoinLimits = JoinLimits()) -> DataFrame:
    """As :func:`order_lines_with_orders`, from tables that are stored by their order."""
    return colocated_lookup(stored, ORDER_TO_FACT, limits).select(
        *LINE_TO_FACT.values(), *ORDER_TO_FACT.values(), "sales_order_line_processed_at"
    )


def fact_sales_order_line(stg: Staging, limits: JoinLimits = JoinLimits()) -> DataFrame:
    """The fact: lines with their orders, the four dates as ``YYYYMMDD`` keys."""
    return fact_parts(stg, replace(limits, parts=0))[0]


def fact_parts(stg: Staging, limits: JoinLimits = JoinLimits()) -> list[DataFrame]:
    """The fact in parts, see :func:`lookup_parts`."""
    keys = {name: date_key(name) for name in FACT_DATE_KEYS}
    return [replace_columns(joined, keys) for joined in order_lines_in_parts(stg, limits)]
