"""Sales metrics over the published mart and fact.

Lines are aggregated by key first; names are looked up for the few rows that
remain. Dates come from the fact's date keys where days outside the calendar count.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.calendar import calendar_quarter, fiscal_year
from starloom.operators.lookup import JoinLimits, Lookup, left_lookups, near_dims
from starloom.sources.workspace import CODEC, new_workspace, shuffles_freed


def revenue() -> Column:
    """Quantity times unit price, tax excluded."""
    return F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")


def revenue_with_tax() -> Column:
    rate = (F.lit(1) + F.col("tax_rate").cast("decimal(6,3)") * F.lit(0.01).cast("decimal(3,2)"))
    return (revenue() * rate.cast("decimal(9,5)")).cast("decimal(38,6)")


def _money(total: Column) -> Column:
    return total.cast("decimal(38,2)")


def _day(key: str) -> Column:
    return F.to_date(F.col(key), "yyyyMMdd")


def revenue_by_line(mart: DataFrame) -> DataFrame:
    """Revenue of each order line, without and with tax."""
    return mart.select(
        "sales_order_line_key",
        "sales_order_key",
        _money(revenue()).alias("revenue"),
        revenue_with_tax().alias("revenue_with_tax"),
    )


def quantity_sold_picked(
    fact: DataFrame, dim_stock_item: DataFrame, limits: JoinLimits = JoinLimits()
) -> DataFrame:
    """Units sold and picked per stock item, and the share picked; several share a name."""
    sold, picked = F.sum("quantity"), F.sum("picked_quantity")
    totals = fact.groupBy("stock_item_key").agg(
        sold.alias("quantity_sold"),
        picked.alias("quantity_picked"),
        F.try_divide(picked, sold).alias("fill_rate"),
    )
    return left_lookups(totals, [_stock_item_name(dim_stock_item)], [], limits)


def _stock_item_name(dim_stock_item: DataFrame) -> Lookup:
    taken = {"stock_item_name": "stock_item_name"}
    return Lookup(dim_stock_item, "stock_item_key", "stock_item_key", taken)


def fulfillment_cycle(fact: DataFrame) -> DataFrame:
    """Days from order to line picking, per calendar year of the order.

    Lines not yet picked count as lines but have no days. Negative days are kept.
    """
    days = F.datediff(
        _day("sales_order_line_picking_completed_date_key"), _day("order_date_key")
    )
    return (
        fact.select(F.substring("order_date_key", 1, 4).alias("order_year"), days.alias("days"))
        .groupBy("order_year")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.count("days").alias("picked_line_count"),
            F.avg("days").alias("average_days"),
            F.min("days").alias("shortest_days"),
            F.max("days").alias("longest_days"),
        )
    )


def customer_totals(fact: DataFrame) -> DataFrame:
    """Lines, orders' span and revenue per customer."""
    return fact.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.min("order_date_key").alias("first_order_date_key"),
        F.max("order_date_key").alias("last_order_date_key"),
        _money(F.sum(revenue())).alias("revenue"),
    )


def customer_lifetime_value(
    fact: DataFrame, dim_customer: DataFrame, limits: JoinLimits = JoinLimits()
) -> DataFrame:
    """Revenue to date per customer."""
    names = {
        "customer_name": "customer_name",
        "customer_category_name": "customer_category_name",
    }
    totals = customer_totals(fact)
    found = Lookup(dim_customer, "customer_key", "customer_key", names)
    return left_lookups(totals, [found], [], limits)


def customer_retention(fact: DataFrame) -> DataFrame:
    """Customers of each fiscal year, and how many of them ordered in the next.

    The year is that of the order's date key, so days outside the calendar count.
    Lines become one row per customer and year before a customer's years, one for
    each year of business at most, are put side by side.
    """
    per_customer = (
        fact.filter("customer_key is not null and order_date_key is not null")
        .select("customer_key", fiscal_year(_day("order_date_key")).alias("fiscal_year"))
        .distinct()
        .groupBy("customer_key")
        .agg(F.collect_list("fiscal_year").alias("years"))
    )
    ordered = per_customer.select(F.explode("years").alias("fiscal_year"), "years")
    again = F.array_contains("years", F.col("fiscal_year") + 1)
    return (
        ordered.select("fiscal_year", F.when(again, 1).otherwise(0).alias("again"))
        .groupBy("fiscal_year")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("again").alias("retained_count"),
            (F.sum("again") / F.count(F.lit(1))).alias("retention_rate"),
        )
    )


def revenue_by_geography(
    fact: DataFrame, dim_customer: DataFrame, limits: JoinLimits = JoinLimits()
) -> DataFrame:
    """Revenue and ordering customers per delivery country and province."""
    places = {
        "delivery_country_name": "delivery_country_name",
        "delivery_state_province_name": "delivery_state_province_name",
    }
    found = Lookup(dim_customer, "customer_key", "customer_key", places)
    return (
        left_lookups(customer_totals(fact), [found], [], limits)
        .groupBy(*places.values())
        .agg(
            F.count("customer_key").alias("customer_count"),
            F.sum("line_count").alias("line_count"),
            _money(F.sum("revenue")).alias("revenue"),
        )
    )


def sales_by_period(
    fact: DataFrame,
    dim_customer: DataFrame,
    dim_stock_item: DataFrame,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """Revenue by customer category, stock item and order period.

    Periods come from the order's date key, not from the calendar. Lines get their customer's
    category and are summed once. Where the customers can be broadcast, no line is shuffled.
    Else the sums, perhaps as many as the lines, are written before names are looked up, so
    that they are worked out once, and in parts by item, so that the shuffles of one part are
    gone before the next.
    """
    day = _day("order_date_key")
    period = ["fiscal_year", "fiscal_qtr"]
    lines = fact.select(
        "customer_key",
        "stock_item_key",
        "quantity",
        "unit_price",
        fiscal_year(day).alias("fiscal_year"),
        calendar_quarter(day).alias("fiscal_qtr"),
    )
    of_lines = [
        F.count(F.lit(1)).alias("line_count"),
        F.sum("quantity").alias("quantity"),
        F.sum(revenue()).alias("revenue"),
    ]
    category = Lookup(
        dim_customer,
        "customer_key",
        "customer_key",
        {"customer_category_name": "customer_category_name"},
    )
    groups = ["customer_category_name", "stock_item_key", *period]
    if near_dims([category], limits):
        small = replace(category, size="bounded")
        by_category = left_lookups(lines, [small], [], limits).groupBy(*groups).agg(*of_lines)
    else:
        spread_by = ["stock_item_key", "quantity", "unit_price", *period]
        with shuffles_freed(fact.sparkSession):
            found = left_lookups(lines, [category], spread_by, limits)
            # Two shuffles of all lines: by customer, and by group.
            of = max(1, min(2 * limits.parts, fact.count() // max(1, limits.part_rows)))
            item = F.pmod(F.xxhash64("stock_item_key"), F.lit(of))
            path = f"{new_workspace(fact.sparkSession)}/sums"
            for number in range(of):
                part = found if of == 1 else found.filter(item == number)
                sums = part.groupBy(*groups).agg(*of_lines)
                sums.write.mode("append").option("compression", CODEC).parquet(path)
        by_category = fact.sparkSession.read.schema(sums.schema).parquet(path)
    return left_lookups(
        by_category.withColumn("revenue", _money(F.col("revenue"))),
        [_stock_item_name(dim_stock_item)],
        ["customer_category_name", *period],
        limits,
    )


# Sketches of customers have 2 ^ this many buckets: a standard error of 0.4 percent.
SKETCH_BITS = 16
# Three standard errors.
SKETCH_ERROR = 0.0125


def customer_sketches(fact: DataFrame, dim_customer: DataFrame, limits: JoinLimits = JoinLimits()) -> DataFrame:
    """(country, province, year, month, lines, sketch): who ordered where and when, mergeable.

    One row per place and month, kept as a table: a load adds the rows of its lines, and any
    rows are rolled up by :func:`customers_by` without going back to the lines. The customer's
    key is sketched as text, so that text and numbers are kept alike.
    """
    places = {
        "delivery_country_name": "delivery_country_name",
        "delivery_state_province_name": "delivery_state_province_name",
    }
    found = Lookup(dim_customer, "customer_key", "customer_key", places)
    months = (
        fact.filter("customer_key is not null")
        .select("customer_key", F.substring("order_date_key", 1, 6).alias("month"))
        .groupBy("customer_key", "month")
        .agg(F.count(F.lit(1)).alias("line_count"))
    )
    return (
        left_lookups(months, [found], ["month"], limits)
        .groupBy(*places.values(), F.substring("month", 1, 4).alias("order_year"), "month")
        .agg(
            F.sum("line_count").alias("line_count"),
            F.hll_sketch_agg(F.col("customer_key").cast("string"), SKETCH_BITS).alias("customers"),
        )
    )


def customers_by(sketches: DataFrame, *columns: str) -> DataFrame:
    """Lines and distinct customers, estimated, for any grouping of the sketches' columns."""
    return sketches.groupBy(*columns).agg(
        F.sum("line_count").alias("line_count"),
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customer_estimate"),
    )


def late_lines(fact: DataFrame) -> DataFrame:
    """Lines picked after the expected delivery, or still open, per expected month."""
    picked = F.col("sales_order_line_picking_completed_date_key")
    expected = F.col("expected_delivery_date_key")
    status = F.when(picked.isNull(), "open").when(picked > expected, "late")
    return (
        fact.select(
            status.alias("line_status"),
            F.substring(expected, 1, 6).alias("expected_month"),
            "quantity",
            "picked_quantity",
        )
        .filter("line_status is not null")
        .groupBy("line_status", "expected_month")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum(F.col("quantity") - F.col("picked_quantity")).alias("outstanding_quantity"),
        )
    )


def customer_orders(fact: DataFrame) -> DataFrame:
    """Order lines per customer."""
    return fact.groupBy("customer_key").agg(F.count(F.lit(1)).alias("order_count"))


def high_value_customers(fact: DataFrame, more_than: int = 10) -> DataFrame:
    """Customers with more order lines than the threshold."""
    counted = customer_orders(fact)
    return counted.filter(F.col("order_count") > more_than).select("customer_key")


def customers_orders_left(
    dim_customer: DataFrame, fact: DataFrame, limits: JoinLimits = JoinLimits()
) -> DataFrame:
    """Customers not on credit hold with their order lines, if any.

    A left join with the many rows on the right cannot be spread by itself, so it
    is two halves: the lines look up their customer, which spreads hot customers,
    and the customers without lines are added.
    """
    shown = ["customer_key", "customer_name"]
    customers = dim_customer.filter(~F.col("is_on_credit_hold")).select(*shown)
    taken = {"customer_key": "found", "customer_name": "customer_name"}
    found = Lookup(customers, "customer_key", "customer_key", taken)
    lines = fact.select("customer_key", "sales_order_line_key", "order_date_key")
    with_lines = left_lookups(lines, [found], ["sales_order_line_key"], limits).filter(
        "found is not null"
    )
    buyers = fact.select("customer_key").distinct()
    without = customers.join(buyers, "customer_key", "left_anti")
    nothing = [
        F.lit(None).cast(fact.schema[name].dataType).alias(name)
        for name in ("sales_order_line_key", "order_date_key")
    ]
    columns = [*shown, "sales_order_line_key", "order_date_key"]
    return with_lines.select(*columns).unionByName(without.select(*shown, *nothing))
