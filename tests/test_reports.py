from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.raw_layer import RawLayer
from checks.registry import Context
from starloom.operators import metrics, quality
from starloom.operators.lookup import JoinLimits
from starloom.plans.integration import city_flatten, dim_customer
from starloom.plans.staging import StagingViews
from tests.conftest import SF_DIR, rows


def test_unique_and_not_null_find_failures_only(spark):
    df = spark.sql("select * from values (1, 'a'), (1, null), (2, 'b'), (null, 'c') as t(k, v)")
    assert rows(quality.unique(df, "t", ["k"])) == [("t", "k", "1", 2)]
    assert rows(quality.not_null(df, "t", "k", ["k", "v"])) == [("t", "1", "v"), ("t", None, "k")]


def test_relationship_ignores_null_and_counts_rows(spark):
    lines = spark.sql("select explode(array(1, 7, 7, null)) as k")
    dim = spark.sql("select 1 as key")
    edges = [quality.Edge("lines", "k", "dim", "key")]
    found = quality.relationships({"lines": lines, "dim": dim}, edges)
    assert rows(found) == [("lines", "k", "7", 2)]


def test_freshness_thresholds(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:00' as at")

    def status(hours, source=df):
        now = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(hours=F.lit(hours))
        return quality.freshness(source, "t", "at", now, 24, 72).first()["status"]

    assert [status(h) for h in (23, 24, 71, 72)] == ["pass", "warn", "warn", "error"]
    assert status(1, df.limit(0)) == "error"


def test_reconcile_shows_both_sides(spark):
    source = spark.sql("select * from values (1, 10), (1, 5), (2, 1), (null, 1) as t(k, m)")
    target = spark.sql("select * from values (1, 15), (3, 1), (null, 1) as t(k, m)")
    result = quality.reconcile(source, target, ["k"], ["m"])
    assert {row["k"]: row["matches"] for row in result.collect()} == {
        1: False,
        2: False,
        3: False,
        None: True,
    }


def test_mismatched_rows_count_multiplicity(spark):
    left = spark.sql("select explode(array(1, 1, 2, null)) as v")
    right = spark.sql("select explode(array(1, 3, null)) as v")
    assert rows(quality.mismatched_rows(left, right)) == [(1, 1), (2, 1), (3, -1)]
    assert quality.mismatched_rows(left, left).count() == 0


def test_naming_rules(spark):
    df = spark.sql(
        "select 1 as customer_key, true as on_hold, true as customer_is_active, 1 as CamelCase,"
        " date'2024-01-01' as order_date_key, cast(1 as double) as price_key"
    )
    assert quality.naming(df, "t") == [
        ("on_hold", "boolean starts with is_"),
        ("CamelCase", "snake_case"),
        ("order_date_key", "date key is YYYYMMDD text"),
        ("price_key", "key is a number or text"),
    ]
    assert quality.naming_report({"t": df.select("customer_key")}).count() == 0


LINES = """
    select * from values
        (1, 10, 'A', 2, 5.00, 10.000, '20240331', '20240402', '20240405'),
        (2, 10, 'A', 1, 1.50, 0.000, '20240401', '20240402', cast(null as string)),
        (3, 20, 'B', 4, 2.25, 5.000, '19991231', '20000105', '19991230'),
        (4, null, 'B', 0, 2.25, 5.000, '20250401', '20250402', '20250402')
    as t(sales_order_line_key, customer_key, stock_item_name, quantity, unit_price, tax_rate,
        order_date_key, expected_delivery_date_key, sales_order_line_picking_completed_date_key)"""


def lines(spark):
    return spark.sql(LINES).withColumns(
        {
            "sales_order_key": F.lit(1),
            "unit_price": F.col("unit_price").cast("decimal(18,2)"),
            "tax_rate": F.col("tax_rate").cast("decimal(18,3)"),
            "picked_quantity": F.when(
                F.col("sales_order_line_picking_completed_date_key").isNull(), 0
            ).otherwise(F.col("quantity")),
        }
    )


def test_revenue_is_exact(spark):
    found = {r["sales_order_line_key"]: r for r in metrics.revenue_by_line(lines(spark)).collect()}
    assert found[1]["revenue"] == Decimal("10.00")
    assert found[1]["revenue_with_tax"] == Decimal("11.000000")
    assert found[3]["revenue_with_tax"] == Decimal("9.450000")


def test_nothing_sold_has_no_fill_rate(spark):
    nothing = lines(spark).filter("quantity = 0")
    items = spark.createDataFrame([(0, "none")], "stock_item_key long, stock_item_name string")
    nothing = nothing.withColumn("stock_item_key", F.lit(1).cast("long"))
    assert metrics.quantity_sold_picked(nothing, items).first()["fill_rate"] is None


def test_late_and_open_lines(spark):
    found = rows(metrics.late_lines(lines(spark)))
    assert found == [("late", "202404", 1, 0), ("open", "202404", 1, 1)]


def test_cycle_may_be_negative_and_reaches_before_the_calendar(spark):
    found = {r["order_year"]: r for r in metrics.fulfillment_cycle(lines(spark)).collect()}
    assert found["1999"]["average_days"] == -1
    assert found["2024"]["line_count"] == 2 and found["2024"]["picked_line_count"] == 1


def test_retention_counts_customers_of_the_next_year(spark):
    """Orders of days before the calendar's first count too."""
    found = {r["fiscal_year"]: tuple(r)[1:] for r in metrics.customer_retention(lines(spark)).collect()}
    assert found[2024] == (1, 1, 1.0) and found[2025][0] == 1
    assert found[2000] == (1, 0, 0.0)


def test_customers_without_lines_stay_unless_on_hold(spark):
    customers = spark.sql(
        "select * from values (10, 'ten', false), (20, 'twenty', true), (30, 'thirty', false),"
        " (40, 'forty', cast(null as boolean)) as t(customer_key, customer_name, is_on_credit_hold)"
    )
    found = rows(metrics.customers_orders_left(customers, lines(spark)))
    assert found == [
        (10, "ten", 1, "20240331"),
        (10, "ten", 2, "20240401"),
        (30, "thirty", None, None),
    ]


def test_high_value_customers(spark):
    assert rows(metrics.high_value_customers(lines(spark), more_than=1)) == [(10,)]


@pytest.mark.parametrize("limits", [JoinLimits(), JoinLimits(broadcast_rows=0, hot_share=0.05)])
@pytest.mark.parametrize(
    "table, key",
    [
        ("application__Cities", "CityID"),
        ("application__StateProvinces", "StateProvinceID"),
        ("application__Countries", "CountryID"),
    ],
)
def test_repeated_places_repeat_customers_in_both_city_roles(spark, table, key, limits):
    raw = dict(RawLayer(spark, SF_DIR.replace("0.01", "0.001")).items())
    one = raw[table].orderBy(key).limit(1)
    raw[table] = raw[table].unionByName(one)
    stg = StagingViews(raw, F.lit("2024-02-01").cast("timestamp"))
    cities = {
        r["city_key"]: r["count"]
        for r in city_flatten(stg, limits).groupBy("city_key").count().collect()
    }
    people = {r[0]: r[1] for r in stg["stg_application_person"].groupBy("person_key").count().collect()}
    expected = sum(
        cities.get(r["delivery_city_key"], 1) * cities.get(r["postal_city_key"], 1)
        * people.get(r["primary_contact_person_key"], 1) * people.get(r["alternate_contact_person_key"], 1)
        for r in stg["stg_sales_customer"].collect()
    )
    found = dim_customer(stg, limits).count()
    assert found == expected


def test_sales_by_period_of_many_customers_sums_the_lines_once(spark):
    """The sums are written in parts, each group in one of them, and names are looked up there."""
    tables = Context(spark, SF_DIR).tables
    fact, customers, items = (tables[n] for n in ("fact_sales_order_line", "dim_customer", "dim_stock_item"))
    # Some lines without an item, without a customer and without a date.
    some = {n: F.when(F.col("sales_order_line_key") % k > 0, F.col(n)) for n, k in (("stock_item_key", 5), ("customer_key", 7), ("order_date_key", 11))}
    lines = fact.withColumns(some)
    near = metrics.sales_by_period(lines, customers, items)
    limits = JoinLimits(broadcast_rows=0, hot_share=0.05, part_rows=1000)
    far = metrics.sales_by_period(lines, customers, items, limits)
    assert far.columns == near.columns and far.dtypes == near.dtypes
    assert not set(far.inputFiles()) & set(fact.inputFiles())
    assert rows(far) == rows(near)
