"""Queries for the data checks and the sales metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.queries_sources import BASE_UNTIL, LANDING_SQL, landing_base, landing_orders
from checks.registry import Context, query
from starloom.operators import metrics, quality

# Data checks


def _unique_sql(relation: str, keys: tuple[str, ...]) -> str:
    value = " || '|' || ".join(f"coalesce(cast({k} as varchar), 'NULL')" for k in keys)
    return (
        f"select '{relation}' as relation, '{'|'.join(keys)}' as key_columns,"
        f" {value} as key_value, count(*) as row_count from {relation}"
        f" group by {', '.join(keys)} having count(*) > 1"
    )


# The last one is not a key of the order lines, and is here to be found out.
UNIQUE_KEYS = (
    ("dim_customer", ("customer_key",)),
    ("dim_stock_item", ("stock_item_key",)),
    ("dim_person", ("person_key",)),
    ("dim_package_type", ("package_type_key",)),
    ("dim_date", ("date_key",)),
    ("fact_sales_order_line", ("sales_order_line_key",)),
    ("stg_application_city", ("city_key",)),
    ("stg_sales_order", ("order_key",)),
    ("fact_sales_order_line", ("sales_order_key", "package_type_key")),
)


@query("\nunion all\n".join(_unique_sql(relation, keys) for relation, keys in UNIQUE_KEYS))
def dq_unique(ctx: Context) -> DataFrame:
    relations = {**ctx.stg, **ctx.tables}
    return quality.unique_all([(relations[name], name, keys) for name, keys in UNIQUE_KEYS])


REQUIRED = ("sales_order_line_key", "customer_key", "picked_by_person_key", "order_date_key")


@query(
    "\nunion all\n".join(
        "select 'fact_sales_order_line' as relation,"
        f" cast(sales_order_line_key as varchar) as key_value, '{name}' as column_name"
        f" from fact_sales_order_line where {name} is null"
        for name in REQUIRED
    )
)
def dq_not_null(ctx: Context) -> DataFrame:
    fact = ctx.tables["fact_sales_order_line"]
    return quality.not_null(fact, "fact_sales_order_line", "sales_order_line_key", REQUIRED)


@query(
    "\nunion all\n".join(
        f"select '{e.relation}' as relation, '{e.column}' as column_name,"
        f" cast({e.column} as varchar) as key_value, count(*) as row_count from {e.relation} r"
        f" where {e.column} is not null and not exists"
        f" (select 1 from {e.target} t where t.{e.target_key} = r.{e.column})"
        f" group by {e.column}"
        for e in quality.STAR_EDGES
    )
)
def dq_relationships(ctx: Context) -> DataFrame:
    return quality.relationships(ctx.tables)


# Edges between integer keys.
INTEGER_EDGES = [e for e in quality.STAR_EDGES if not e.column.endswith("date_key")]


def _missing_sql(e: quality.Edge) -> str:
    return (
        f"select '{e.relation}' as relation, '{e.column}' as column_name,"
        f" cast({e.column} as varchar) as key_value, count(*) as row_count from {e.relation} r"
        f" where {e.column} is not null and not exists"
        f" (select 1 from {e.target} t where t.{e.target_key} = r.{e.column})"
        f" group by {e.column}"
    )


def _all(frames) -> DataFrame:
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first


@query("\nunion all\n".join(map(_missing_sql, INTEGER_EDGES)))
def dq_relationships_bitmap(ctx: Context) -> DataFrame:
    """The same by bitmaps of keys, for the references between integers."""
    return _all(
        quality.relationship_by_bitmap(ctx.tables[e.relation], ctx.tables[e.target], e)
        for e in INTEGER_EDGES
    )


BITMAP_KEYS = (
    ("dim_customer", "customer_key"),
    ("dim_stock_item", "stock_item_key"),
    ("dim_person", "person_key"),
    ("stg_sales_order", "order_key"),
    ("fact_sales_order_line", "sales_order_key"),
)


@query("\nunion all\n".join(_unique_sql(relation, (key,)) for relation, key in BITMAP_KEYS))
def dq_unique_bitmap(ctx: Context) -> DataFrame:
    """Repeated integer keys by bitmaps; the last one isn't a key of its table."""
    relations = {**ctx.stg, **ctx.tables}
    return _all(quality.unique_by_bitmap(relations[name], name, key) for name, key in BITMAP_KEYS)


FRESH_NOW = "2024-02-01 00:00:00"


def _freshness_sql(relation: str, column: str) -> str:
    age = f"cast(floor(epoch(timestamp '{FRESH_NOW}' - max({column})) / 3600) as bigint)"
    return (
        f"select '{relation}' as relation, max({column}) as latest, {age} as age_hours,"
        f" case when {age} < 24 then 'pass' when {age} < 72 then 'warn' else 'error' end as status"
        f" from {relation}"
    )


@query(_freshness_sql("events", "ts") + "\nunion all\n" + _freshness_sql("orders", "o_orderdate"))
def dq_freshness(ctx: Context) -> DataFrame:
    now = F.lit(FRESH_NOW).cast("timestamp")
    events = quality.freshness(ctx.given("events"), "events", "ts", now, 24, 72)
    orders = quality.freshness(ctx.given("orders"), "orders", "o_orderdate", now, 24, 72)
    return events.unionByName(orders)


MEASURES = ("quantity", "picked_quantity", "unit_price")


def _totals_sql(relation: str) -> str:
    return (
        "select stock_item_key, count(*) as n, cast(sum(quantity) as bigint) as q,"
        " cast(sum(picked_quantity) as bigint) as p, cast(sum(unit_price) as decimal(28,2)) as u"
        f" from {relation} group by stock_item_key"
    )


@query(
    f"""
    select coalesce(s.stock_item_key, w.stock_item_key) as stock_item_key,
        s.n as source_rows, w.n as warehouse_rows, s.q as source_quantity,
        w.q as warehouse_quantity, s.p as source_picked_quantity,
        w.p as warehouse_picked_quantity, s.u as source_unit_price, w.u as warehouse_unit_price,
        s.n = w.n and s.q = w.q and s.p = w.p and s.u = w.u as matches
    from ({_totals_sql('stg_sales_order_line')}) s
    full join ({_totals_sql('fact_sales_order_line')}) w using (stock_item_key)"""
)
def dq_reconcile(ctx: Context) -> DataFrame:
    """Order lines as delivered beside the fact, per stock item."""
    source, fact = ctx.stg["stg_sales_order_line"], ctx.tables["fact_sales_order_line"]
    return quality.reconcile(source, fact, ["stock_item_key"], MEASURES)


@query(
    f"select *, cast(1 as bigint) as surplus from ({LANDING_SQL}) o"
    f" where updated >= '{BASE_UNTIL}'"
)
def dq_reconcile_rows(ctx: Context) -> DataFrame:
    """Orders the source has and a warehouse loaded from the first export lacks."""
    landed = ctx.store.replace(landing_base(ctx), "raw", "landing_orders")
    return quality.mismatched_rows(landing_orders(ctx), landed)




_CHANGED = "order_key >= 5000 and order_key < 7000"


@query(
    f"""
    select * from (with source as ({LANDING_SQL}),
    signed as (
        select *, 1 as side from source
        union all
        select order_key, customer_key, status,
            cast(case when {_CHANGED} and order_key % 5 = 0 then total + 1 else total end as decimal(18,2)),
            updated, -1
        from source where not ({_CHANGED} and order_key % 7 = 0))
    select order_key, customer_key, status, total, updated, cast(sum(side) as bigint) as surplus
    from signed group by all having sum(side) <> 0)"""
)
def dq_reconcile_digest(ctx: Context) -> DataFrame:
    """Orders beside a copy in which some of one range of keys are changed or lacking."""
    more = F.when(F.expr(f"{_CHANGED} and order_key % 5 = 0"), 1).otherwise(0)
    copy = (
        landing_orders(ctx)
        .filter(~F.expr(f"{_CHANGED} and order_key % 7 = 0"))
        .withColumn("total", (F.col("total") + more).cast("decimal(18,2)"))
    )
    # Laid out by the key, so that the ranges that agree can be skipped.
    landed = ctx.store.replace(copy.orderBy("order_key"), "raw", "landing_copy")
    return quality.mismatched_rows_by_digest(landing_orders(ctx), landed, "order_key", 1000)


def _naming_sql() -> str:
    found = [
        ("raw_orders", "OrderID", "snake_case", "sales__Orders"),
        ("raw_orders", "CustomerID", "snake_case", "sales__Orders"),
        ("raw_orders", "SalespersonPersonID", "snake_case", "sales__Orders"),
        ("raw_orders", "PickedByPersonID", "snake_case", "sales__Orders"),
        ("raw_orders", "ContactPersonID", "snake_case", "sales__Orders"),
        ("raw_orders", "BackorderOrderID", "snake_case", "sales__Orders"),
        ("raw_orders", "OrderDate", "snake_case", "sales__Orders"),
        ("raw_orders", "ExpectedDeliveryDate", "snake_case", "sales__Orders"),
        ("raw_orders", "IsUndersupplyBackordered", "snake_case", "sales__Orders"),
        ("raw_orders", "IsUndersupplyBackordered", "boolean starts with is_", "sales__Orders"),
        ("raw_orders", "PickingCompletedWhen", "snake_case", "sales__Orders"),
        ("stg_sales_order", "order_date_key", "date key is YYYYMMDD text", "stg_sales_order"),
        (
            "stg_sales_order",
            "expected_delivery_date_key",
            "date key is YYYYMMDD text",
            "stg_sales_order",
        ),
        (
            "stg_sales_order",
            "picking_completed_date_key",
            "date key is YYYYMMDD text",
            "stg_sales_order",
        ),
    ]
    return "\nunion all\n".join(
        f"select '{relation}' as relation, '{column}' as column_name, '{rule}' as rule,"
        f" count({column}) as value_count from {source}"
        for relation, column, rule, source in found
    )


@query(_naming_sql())
def dq_naming(ctx: Context) -> DataFrame:
    """Names in raw, staging and mart; the mart's follow the rules."""
    return quality.naming_report(
        {
            "raw_orders": ctx.raw["sales__Orders"],
            "stg_sales_order": ctx.stg["stg_sales_order"],
            "mart_sales_order_line": ctx.mart,
        }
    )


# Sales metrics

REVENUE_SQL = "cast(quantity as decimal(10,0)) * unit_price"


@query(
    f"""
    select sales_order_line_key, sales_order_key, cast({REVENUE_SQL} as decimal(38,2)) as revenue,
        cast({REVENUE_SQL} * cast(1 + tax_rate * 0.01 as decimal(9,5)) as decimal(38,6))
            as revenue_with_tax
    from mart_sales_order_line"""
)
def revenue_by_line(ctx: Context) -> DataFrame:
    return metrics.revenue_by_line(ctx.mart)


@query(
    """
    select t.stock_item_key, i.stock_item_name, t.quantity_sold, t.quantity_picked, t.fill_rate
    from (
        select stock_item_key, cast(sum(quantity) as bigint) as quantity_sold,
            cast(sum(picked_quantity) as bigint) as quantity_picked,
            cast(sum(picked_quantity) as double) / nullif(sum(quantity), 0) as fill_rate
        from fact_sales_order_line group by stock_item_key
    ) t left join dim_stock_item i using (stock_item_key)"""
)
def quantity_sold_picked(ctx: Context) -> DataFrame:
    return metrics.quantity_sold_picked(
        ctx.tables["fact_sales_order_line"], ctx.tables["dim_stock_item"]
    )


@query(
    """
    select order_year, count(*) as line_count, count(days) as picked_line_count,
        avg(days) as average_days, cast(min(days) as int) as shortest_days,
        cast(max(days) as int) as longest_days
    from (
        select strftime(order_date_key, '%Y') as order_year,
            date_diff('day', cast(order_date_key as date),
                cast(sales_order_line_picking_completed_date_key as date)) as days
        from line_with_order
    ) l group by order_year"""
)
def fulfillment_cycle(ctx: Context) -> DataFrame:
    return metrics.fulfillment_cycle(ctx.tables["fact_sales_order_line"])


CUSTOMER_TOTALS_SQL = f"""
    select customer_key, count(*) as line_count, min(order_date_key) as first_order_date_key,
        max(order_date_key) as last_order_date_key,
        cast(sum({REVENUE_SQL}) as decimal(38,2)) as revenue
    from fact_sales_order_line group by customer_key"""


@query(
    f"""
    select t.*, c.customer_name, c.customer_category_name
    from ({CUSTOMER_TOTALS_SQL}) t left join dim_customer c using (customer_key)"""
)
def customer_lifetime_value(ctx: Context) -> DataFrame:
    return metrics.customer_lifetime_value(
        ctx.tables["fact_sales_order_line"], ctx.tables["dim_customer"]
    )


# A fiscal year starts in April and has the number of the year that it ends in.
FISCAL_YEAR_SQL = "cast(year(d) + case when month(d) >= 4 then 1 else 0 end as int)"
ORDER_DAY_SQL = "strptime(order_date_key, '%Y%m%d')"


@query(
    f"""
    select a.fiscal_year, count(*) as customer_count, count(b.customer_key) as retained_count,
        cast(count(b.customer_key) as double) / count(*) as retention_rate
    from (select distinct customer_key, {FISCAL_YEAR_SQL} as fiscal_year
        from (select customer_key, {ORDER_DAY_SQL} as d from fact_sales_order_line)
        where customer_key is not null and d is not null) a
    left join (select distinct customer_key, {FISCAL_YEAR_SQL} as fiscal_year
        from (select customer_key, {ORDER_DAY_SQL} as d from fact_sales_order_line)) b
        on b.customer_key = a.customer_key and b.fiscal_year = a.fiscal_year + 1
    group by a.fiscal_year"""
)
def customer_retention(ctx: Context) -> DataFrame:
    return metrics.customer_retention(ctx.tables["fact_sales_order_line"])


@query(
    f"""
    select c.delivery_country_name, c.delivery_state_province_name,
        count(t.customer_key) as customer_count, cast(sum(t.line_count) as bigint) as line_count,
        cast(sum(t.revenue) as decimal(38,2)) as revenue
    from ({CUSTOMER_TOTALS_SQL}) t left join dim_customer c using (customer_key)
    group by c.delivery_country_name, c.delivery_state_province_name"""
)
def revenue_by_geography(ctx: Context) -> DataFrame:
    return metrics.revenue_by_geography(
        ctx.tables["fact_sales_order_line"], ctx.tables["dim_customer"]
    )


@query(
    f"""
    select c.customer_category_name, f.stock_item_key, i.stock_item_name,
        {FISCAL_YEAR_SQL} as fiscal_year, 'Q' || quarter(d) as fiscal_qtr,
        count(*) as line_count, cast(sum(quantity) as bigint) as quantity,
        cast(sum(cast(quantity as decimal(10,0)) * f.unit_price) as decimal(38,2)) as revenue
    from (select *, {ORDER_DAY_SQL} as d from fact_sales_order_line) f
    left join dim_customer c using (customer_key)
    left join dim_stock_item i using (stock_item_key)
    group by 1, 2, 3, 4, 5"""
)
def sales_by_period(ctx: Context) -> DataFrame:
    return metrics.sales_by_period(
        ctx.tables["fact_sales_order_line"],
        ctx.tables["dim_customer"],
        ctx.tables["dim_stock_item"],
    )


@query(
    """
    select line_status, expected_month, count(*) as line_count,
        cast(sum(quantity - picked_quantity) as bigint) as outstanding_quantity
    from (
        select case when sales_order_line_picking_completed_date_key is null then 'open'
                when cast(sales_order_line_picking_completed_date_key as date)
                    > expected_delivery_date_key then 'late' end as line_status,
            strftime(expected_delivery_date_key, '%Y%m') as expected_month, quantity,
            picked_quantity
        from line_with_order
    ) l where line_status is not null group by line_status, expected_month"""
)
def late_lines(ctx: Context) -> DataFrame:
    return metrics.late_lines(ctx.tables["fact_sales_order_line"])


@query(
    f"""
    select c.delivery_country_name, cast(year(d) as varchar) as order_year, count(*) as line_count,
        count(distinct customer_key) as customer_count, true as within_error
    from (select *, {ORDER_DAY_SQL} as d from fact_sales_order_line where customer_key is not null) f
    left join dim_customer c using (customer_key)
    group by 1, 2"""
)
def customers_by_period_sketch(ctx: Context) -> DataFrame:
    """Customers per country and year, rolled up from sketches per province and month."""
    fact, customers = ctx.tables["fact_sales_order_line"], ctx.tables["dim_customer"]
    sketches = metrics.customer_sketches(fact, customers)
    kept = ctx.store.replace(sketches, "dwh", "customer_sketches")
    by = ["delivery_country_name", "order_year"]
    estimated = metrics.customers_by(kept, *by)
    # The exact numbers, to say how far off the estimates are.
    exact = (
        fact.filter("customer_key is not null")
        .select("customer_key", F.substring("order_date_key", 1, 4).alias("exact_year"))
        .distinct()
        .join(customers.select("customer_key", F.col("delivery_country_name").alias("country")), "customer_key", "left")
        .groupBy("country", "exact_year")
        .agg(F.count(F.lit(1)).alias("customer_count"))
    )
    same = F.col("country").eqNullSafe(F.col("delivery_country_name")) & F.col("exact_year").eqNullSafe(F.col("order_year"))
    off = F.abs(F.col("customer_estimate") - F.col("customer_count"))
    return estimated.join(exact, same).select(
        *by,
        "line_count",
        "customer_count",
        (off <= F.greatest(F.lit(1), F.col("customer_count") * metrics.SKETCH_ERROR)).alias("within_error"),
    )
