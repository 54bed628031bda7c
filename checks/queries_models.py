"""Queries for the warehouse models, their joins, column lists and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import Context, query
from starloom.functions import calendar, columns
from starloom.operators import metrics
from starloom.operators.lookup import Lookup, left_lookups
from starloom.plans import integration, mart
from starloom.plans.staging import STAGING

# Models


def _staging(model: str):
    @query(f"select * from {model}", name=model)
    def staging_model(ctx: Context) -> DataFrame:
        return ctx.stg[model]


for _model in STAGING:
    _staging(_model)


@query("select * from dim_customer")
def stg_dim_customer_wwi(ctx: Context) -> DataFrame:
    return integration.dim_customer(ctx.stg)


@query("select * from dim_package_type")
def stg_dim_package_type_wwi(ctx: Context) -> DataFrame:
    return integration.dim_package_type(ctx.stg)


@query("select * from dim_person")
def stg_dim_person_wwi(ctx: Context) -> DataFrame:
    return integration.dim_person(ctx.stg)


@query("select * from dim_stock_item")
def stg_dim_stock_item_wwi(ctx: Context) -> DataFrame:
    return integration.dim_stock_item(ctx.stg)


@query("select * from fact_sales_order_line")
def stg_fact_sales_order_line_wwi(ctx: Context) -> DataFrame:
    return integration.fact_sales_order_line(ctx.stg)


def _published(model: str):
    @query(f"select * from {model}", name=model)
    def published_model(ctx: Context) -> DataFrame:
        return ctx.published[model] if model.startswith("mart_") else ctx.tables[model]


for _model in (
    "dim_customer",
    "dim_package_type",
    "dim_person",
    "dim_stock_item",
    "fact_sales_order_line",
    "dim_contact_person",
    "dim_picked_by_person",
    "dim_salesperson_person",
    "mart_sales_order_line",
):
    _published(_model)


@query(
    """
    select d.*, coalesce(o.order_line_count, 0) as order_line_count
    from dim_date d
    left join (
        select order_date_key, count(*) as order_line_count
        from fact_sales_order_line group by order_date_key
    ) o on o.order_date_key = d.date_key"""
)
def dim_date(ctx: Context) -> DataFrame:
    """The whole calendar with the order lines of each day."""
    lines = (
        ctx.tables["fact_sales_order_line"]
        .groupBy("order_date_key")
        .agg(F.count(F.lit(1)).alias("order_line_count"))
    )
    days = ctx.tables["dim_date"]
    counted = days.join(lines, days.date_key == lines.order_date_key, "left")
    number = F.coalesce("order_line_count", F.lit(0)).alias("order_line_count")
    return counted.select(*days.columns, number)


# Joins


@query(
    """
    select si.stock_item_key, si.stock_item_name, wc.color_name
    from stg_warehouse_stock_item si
    left join stg_warehouse_color wc on wc.color_key = si.color_key"""
)
def left_lookup(ctx: Context) -> DataFrame:
    items = ctx.stg["stg_warehouse_stock_item"].select(
        "stock_item_key", "stock_item_name", "color_key"
    )
    color = Lookup(
        ctx.stg["stg_warehouse_color"], "color_key", "color_key", {"color_name": "color_name"}
    )
    return left_lookups(items, [color], ["stock_item_key"]).drop("color_key")


@query("select * from line_with_order")
def stg_fact_sales_order_line(ctx: Context) -> DataFrame:
    """Order lines with their header, dates still dates."""
    return integration.order_lines_with_orders(ctx.stg)


@query("select * from line_with_order")
def stg_fact_sales_order_line_bucketed(ctx: Context) -> DataFrame:
    """The same from lines and orders that are stored in buckets of their order."""
    stored = integration.stored_by_order(ctx.stg, f"{ctx.store.root}/by_order", buckets=8)
    return integration.stored_lines_with_orders(stored)


@query("select * from city_flat")
def city_flatten(ctx: Context) -> DataFrame:
    return integration.city_flatten(ctx.stg)


@query(
    """
    select si.stock_item_key, up.package_type_name as unit_package_type_name,
        op.package_type_name as outer_package_type_name
    from stg_warehouse_stock_item si
    left join stg_warehouse_package_type up on up.package_type_key = si.unit_package_type_key
    left join stg_warehouse_package_type op on op.package_type_key = si.outer_package_type_key"""
)
def stg_dim_stock_item(ctx: Context) -> DataFrame:
    """One lookup under two roles."""
    keys = ("unit_package_type_key", "outer_package_type_key")
    items = ctx.stg["stg_warehouse_stock_item"].select("stock_item_key", *keys)
    lookups = integration.package_lookups(ctx.stg)
    return left_lookups(items, lookups, ["stock_item_key"]).drop(*keys)


@query(
    """
    select cu.customer_key, p1.person_full_name as primary_contact_full_name,
        p1.is_system_user as primary_contact_is_system_user,
        p1.is_employee as primary_contact_is_employee,
        p1.is_salesperson as primary_contact_is_salesperson,
        p1.phone_number as primary_contact_phone_number,
        p1.email_address as primary_contact_email_address,
        p2.person_full_name as alternate_contact_full_name
    from stg_sales_customer cu
    left join stg_application_person p1 on p1.person_key = cu.primary_contact_person_key
    left join stg_application_person p2 on p2.person_key = cu.alternate_contact_person_key"""
)
def role_lookup_person(ctx: Context) -> DataFrame:
    keys = ("primary_contact_person_key", "alternate_contact_person_key")
    customers = ctx.stg["stg_sales_customer"].select("customer_key", *keys)
    lookups = integration.contact_lookups(ctx.stg)
    return left_lookups(customers, lookups, ["customer_key"]).drop(*keys)


def _city_role_sql(alias: str, role: str) -> str:
    names = ("country_name", "country_formal_name", "country_type", "country_population")
    names = ("city_name", "state_province_name", "state_province_population", *names)
    return ", ".join(f"{alias}.{name} as {role}_{name}" for name in names)


@query(
    f"""
    select cu.customer_key, {_city_role_sql('dc', 'delivery')}, {_city_role_sql('pc', 'postal')}
    from stg_sales_customer cu
    left join city_flat dc on dc.city_key = cu.delivery_city_key
    left join city_flat pc on pc.city_key = cu.postal_city_key"""
)
def stg_dim_customer(ctx: Context) -> DataFrame:
    """The flattened city, a derived table, joined under two roles."""
    keys = ("delivery_city_key", "postal_city_key")
    cities = integration.city_flatten(ctx.stg)
    lookups = [integration.city_lookup(cities, role) for role in ("delivery", "postal")]
    customers = ctx.stg["stg_sales_customer"].select("customer_key", *keys)
    return left_lookups(customers, lookups, ["customer_key"]).drop(*keys)


@query(
    """
    select c.customer_key, c.customer_name, b.customer_name as bill_to_customer_name
    from dim_customer c left join dim_customer b on b.customer_key = c.bill_to_customer_key"""
)
def bill_to_customer(ctx: Context) -> DataFrame:
    return mart.customer_with_bill_to(ctx.tables["dim_customer"]).select(
        "customer_key", "customer_name", "bill_to_customer_name"
    )


ROLE_DATES_SQL = """
    from fact_sales_order_line f
    left join dim_date d1 on d1.date_key = f.order_date_key
    left join dim_date d2 on d2.date_key = f.expected_delivery_date_key
    left join dim_date d3 on d3.date_key = f.sales_order_picking_completed_date_key
    left join dim_date d4 on d4.date_key = f.sales_order_line_picking_completed_date_key"""


@query(
    f"""
    select f.sales_order_line_key, f.order_date_key, d1.full_date as order_date_full_date,
        d2.full_date as expected_delivery_date_full_date,
        d3.full_date as sales_order_picking_completed_date_full_date,
        d4.full_date as sales_order_line_picking_completed_date_full_date
    {ROLE_DATES_SQL}"""
)
def role_playing_date_join(ctx: Context) -> DataFrame:
    roles = (*mart.FULL_DATE_ROLES, *mart.SHORT_DATE_ROLES)
    lookups = [
        Lookup(
            ctx.tables["dim_date"],
            f"{role}_key",
            "date_key",
            {"full_date": f"{role}_full_date"},
            size="bounded",
        )
        for role in roles
    ]
    fact = ctx.tables["fact_sales_order_line"]
    joined = left_lookups(fact, lookups, ["sales_order_line_key"])
    return joined.select(
        "sales_order_line_key", "order_date_key", *[f"{role}_full_date" for role in roles]
    )


@query(
    """
    select f.sales_order_line_key, sp.person_full_name as salesperson_person_full_name,
        pk.person_full_name as picked_by_person_person_full_name,
        ct.person_full_name as contact_person_person_full_name
    from fact_sales_order_line f
    left join dim_person sp on sp.person_key = f.salesperson_key
    left join dim_person pk on pk.person_key = f.picked_by_person_key
    left join dim_person ct on ct.person_key = f.contact_person_key"""
)
def role_playing_person_join(ctx: Context) -> DataFrame:
    keys = list(mart.PERSON_ROLES)
    fact = ctx.tables["fact_sales_order_line"].select("sales_order_line_key", *keys)
    lookups = mart.person_lookups(ctx.tables["dim_person"])
    return left_lookups(fact, lookups, ["sales_order_line_key"]).drop(*keys)


@query(
    """
    select c.customer_key, c.customer_name, f.sales_order_line_key, f.order_date_key
    from dim_customer c
    left join fact_sales_order_line f on f.customer_key = c.customer_key
    where c.is_on_credit_hold = false"""
)
def customers_orders_left(ctx: Context) -> DataFrame:
    return metrics.customers_orders_left(
        ctx.tables["dim_customer"], ctx.tables["fact_sales_order_line"]
    )


@query(
    """
    select customer_key, count(*) as order_count from fact_sales_order_line group by customer_key"""
)
def customer_orders(ctx: Context) -> DataFrame:
    return metrics.customer_orders(ctx.tables["fact_sales_order_line"])


@query(
    """
    select customer_key from fact_sales_order_line group by customer_key having count(*) > 10"""
)
def high_value_customers(ctx: Context) -> DataFrame:
    return metrics.high_value_customers(ctx.tables["fact_sales_order_line"])


# Column lists


@query(
    """
    select order_key, customer_key, salesperson_key, picked_by_person_key, contact_person_key,
        backorder_order_key, is_undersupply_backordered, processed_at,
        strftime(order_date_key, '%Y%m%d') as order_date_key,
        strftime(expected_delivery_date_key, '%Y%m%d') as expected_delivery_date_key,
        strftime(picking_completed_date_key, '%Y%m%d') as picking_completed_date_key
    from stg_sales_order"""
)
def star_except(ctx: Context) -> DataFrame:
    names = ("order_date_key", "expected_delivery_date_key", "picking_completed_date_key")
    keys = {name: calendar.date_key(name) for name in names}
    return columns.replace_columns(ctx.stg["stg_sales_order"], keys)


CUSTOMER_REST = integration.CUSTOMER_COLUMNS[1:2] + integration.CUSTOMER_COLUMNS[3:4] + tuple(
    name
    for name in integration.CUSTOMER_COLUMNS[5:]
    if name not in ("delivery_city_key", "postal_city_key")
)


@query(f"select {', '.join(CUSTOMER_REST)} from dim_customer")
def filtered_columns(ctx: Context) -> DataFrame:
    customers = ctx.tables["dim_customer"]
    return customers.select(*columns.filtered_columns(customers, mart.CUSTOMER_EXCLUDED))


@query(f"select {', '.join(f'{n} as customer_{n}' for n in CUSTOMER_REST)} from dim_customer")
def prefixed_columns(ctx: Context) -> DataFrame:
    customers = ctx.tables["dim_customer"]
    kept = columns.filtered_columns(customers, mart.CUSTOMER_EXCLUDED)
    return columns.rename_select(customers, columns.prefixed(kept, "customer_"))


CALENDAR_SQL_NAMES = (
    "full_date, year, year_week, year_day, fiscal_year, fiscal_qtr, month, month_name, week_day,"
    " day_name, day_is_weekday"
).split(", ")


@query(
    "select f.sales_order_line_key, "
    + ", ".join(
        f'd1."{n}" as order_date_{n}, d2."{n}" as expected_delivery_date_{n}'
        for n in CALENDAR_SQL_NAMES
    )
    + ROLE_DATES_SQL
)
def interleaved_columns(ctx: Context) -> DataFrame:
    """Two prefixed copies of the calendar, alternating column by column."""
    dates = ctx.tables["dim_date"]
    fact = ctx.tables["fact_sales_order_line"]
    keys = [f"{role}_key" for role in mart.FULL_DATE_ROLES]
    lookups = [lk for lk in mart.date_lookups(dates) if lk.key in keys]
    fact = fact.select("sales_order_line_key", *keys)
    joined = left_lookups(fact, lookups, ["sales_order_line_key"])
    names = columns.filtered_columns(dates, mart.DATE_EXCLUDED)
    prefixes = [f"{role}_" for role in mart.FULL_DATE_ROLES]
    return joined.select("sales_order_line_key", *columns.interleaved(names, prefixes))


@query("select * from dim_person where is_salesperson = true")
def filter_boolean(ctx: Context) -> DataFrame:
    return ctx.tables["dim_person"].filter("is_salesperson")


# Scalar functions, over the dates of all orders and the addresses of all customers


def _order_dates(ctx: Context, **values) -> DataFrame:
    orders = ctx.raw["sales__Orders"]
    return orders.select("OrderID", *[value.alias(name) for name, value in values.items()])


@query(
    """
    select OrderID, strftime(OrderDate, '%Y%m%d') as order_date_key,
        strftime(ExpectedDeliveryDate, '%Y%m%d') as expected_delivery_date_key,
        strftime(PickingCompletedWhen, '%Y%m%d') as picking_completed_date_key
    from sales__Orders"""
)
def date_key(ctx: Context) -> DataFrame:
    return _order_dates(
        ctx,
        order_date_key=calendar.date_key("OrderDate"),
        expected_delivery_date_key=calendar.date_key("ExpectedDeliveryDate"),
        picking_completed_date_key=calendar.date_key("PickingCompletedWhen"),
    )


@query("select OrderID, monthname(OrderDate) as month_name from sales__Orders")
def month_name(ctx: Context) -> DataFrame:
    return _order_dates(ctx, month_name=calendar.month_name("OrderDate"))


@query("select OrderID, dayname(OrderDate) as day_name from sales__Orders")
def day_name(ctx: Context) -> DataFrame:
    return _order_dates(ctx, day_name=calendar.day_name("OrderDate"))


@query(
    """
    select OrderID, cast(year(OrderDate) as int) as year_number,
        cast(month(OrderDate) as int) as month_number,
        cast(dayofyear(OrderDate) as int) as day_of_year,
        cast(dayofweek(OrderDate) + 1 as int) as week_day
    from sales__Orders"""
)
def date_parts(ctx: Context) -> DataFrame:
    day = F.col("OrderDate")
    return _order_dates(
        ctx,
        year_number=F.year(day),
        month_number=F.month(day),
        day_of_year=F.dayofyear(day),
        week_day=F.dayofweek(day),
    )


@query("select OrderID, cast(strftime(OrderDate, '%U') as int) as week from sales__Orders")
def week_sunday(ctx: Context) -> DataFrame:
    return _order_dates(ctx, week=calendar.week_of_year("OrderDate"))


@query(
    """
    select OrderID, 'Q' || cast(quarter(OrderDate) as varchar) as calendar_quarter
    from sales__Orders"""
)
def calendar_quarter(ctx: Context) -> DataFrame:
    return _order_dates(ctx, calendar_quarter=calendar.calendar_quarter("OrderDate"))


@query(
    """
    select OrderID,
        cast(year(OrderDate) + case when month(OrderDate) >= 4 then 1 else 0 end as int)
            as fiscal_year
    from sales__Orders"""
)
def fiscal_year(ctx: Context) -> DataFrame:
    return _order_dates(ctx, fiscal_year=calendar.fiscal_year("OrderDate"))


@query(
    """
    select OrderID, cast(case when dayofweek(OrderDate) in (0, 6) then 0 else 1 end as int)
            as day_is_weekday
    from sales__Orders"""
)
def weekday_flag(ctx: Context) -> DataFrame:
    return _order_dates(ctx, day_is_weekday=calendar.weekday_flag("OrderDate"))


@query(
    """
    select OrderID, cast(year(OrderDate) * 100 + cast(strftime(OrderDate, '%U') as int) as int)
            as year_week
    from sales__Orders"""
)
def year_week(ctx: Context) -> DataFrame:
    return _order_dates(ctx, year_week=calendar.year_week("OrderDate"))


@query(
    """
    select OrderID, cast(year(OrderDate) * 1000 + dayofyear(OrderDate) as int) as year_day
    from sales__Orders"""
)
def year_day(ctx: Context) -> DataFrame:
    return _order_dates(ctx, year_day=calendar.year_day("OrderDate"))


@query(
    """
    select customer_key,
        delivery_address_line_1 || ' ' || delivery_address_line_2 as delivery_address,
        postal_address_line_1 || ' ' || postal_address_line_2 as postal_address
    from stg_sales_customer"""
)
def address_concat(ctx: Context) -> DataFrame:
    """NULL as soon as one line is."""
    return ctx.stg["stg_sales_customer"].select(
        "customer_key", integration.address("delivery"), integration.address("postal")
    )
