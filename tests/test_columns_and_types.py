from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.raw_layer import RawLayer
from checks.registry import Context
from starloom.functions import coercion, columns
from starloom.plans import integration, mart, roles
from starloom.plans.staging import STAGING, StagingViews, stage
from starloom.sources import contracts
from tests.conftest import SF_DIR, rows


def test_filtered_columns_keep_order_and_ignore_case(spark):
    df = spark.range(1).selectExpr("1 as b", "2 as a", "3 as C")
    assert columns.filtered_columns(df, ["A"]) == ["b", "C"]


def test_an_excluded_name_that_matches_nothing_is_reported(spark):
    with pytest.warns(UserWarning, match="ab"):
        assert columns.filtered_columns(spark.range(1), ["ab"]) == ["id"]


def test_interleaved_and_prefixed():
    assert columns.interleaved(["x", "y"], ["a_", "b_"]) == ["a_x", "b_x", "a_y", "b_y"]
    assert columns.prefixed(["x"], "a_") == {"x": "a_x"}


def test_replaced_columns_move_to_the_end(spark):
    df = spark.range(1).selectExpr("1 as a", "2 as b", "3 as c")
    assert columns.replace_columns(df, {"b": F.lit("z")}).columns == ["a", "c", "b"]


def test_widths_of_the_published_relations(spark):
    tables = Context(spark, SF_DIR).published
    widths = {name: len(df.columns) for name, df in tables.items()}
    assert widths == {
        "dim_customer": 34,
        "dim_stock_item": 17,
        "dim_person": 8,
        "dim_package_type": 2,
        "dim_date": 12,
        "fact_sales_order_line": 19,
        "dim_contact_person": 6,
        "dim_picked_by_person": 6,
        "dim_salesperson_person": 6,
        "mart_sales_order_line": 72,
    }


def test_mart_column_order(spark):
    tables = Context(spark, SF_DIR).published
    names = tables["mart_sales_order_line"].columns
    assert names == mart.mart_columns(tables)
    assert names[:10] == [
        "sales_order_line_key", "sales_order_key", "quantity", "unit_price", "tax_rate",
        "picked_quantity", "salesperson_key", "backorder_order_key",
        "is_undersupply_backordered", "sales_order_line_processed_at",
    ]
    assert names[39:43] == [
        "bill_to_customer_name", "salesperson_person_full_name",
        "picked_by_person_person_full_name", "contact_person_person_full_name",
    ]
    assert names[48:52] == [
        "order_date_full_date", "expected_delivery_date_full_date",
        "order_date_year", "expected_delivery_date_year",
    ]
    assert names[70:] == [
        "sales_order_picking_completed_date_full_date",
        "sales_order_line_picking_completed_date_full_date",
    ]


def test_repeated_city_keys_repeat_customers(spark):
    """The postal city adds no column, but joining it to repeated keys adds rows."""
    raw = dict(RawLayer(spark, SF_DIR))
    cities = raw["application__Cities"]
    raw["application__Cities"] = cities.unionByName(cities.filter("CityID = 10"))
    repeated = integration.dim_customer(StagingViews(raw, Context.loaded_at()))
    twice = F.when(F.col("DeliveryCityID") == 10, 2).otherwise(1)
    again = F.when(F.col("PostalCityID") == 10, 2).otherwise(1)
    customers = raw["sales__Customers"]
    assert customers.filter("PostalCityID = 10").count() > 0
    assert repeated.count() == customers.agg(F.sum(twice * again)).first()[0]
    assert tuple(repeated.columns) == integration.CUSTOMER_COLUMNS


def test_fact_dates_come_last(spark):
    names = Context(spark, SF_DIR).published["fact_sales_order_line"].columns
    assert tuple(names[-4:]) == integration.FACT_DATE_KEYS


def test_role_views_with_the_remaining_columns(spark):
    people = spark.sql(
        "select 1 as person_key, 'n' as person_full_name, 'p' as person_preferred_name,"
        " true as is_system_user, true as is_employee, cast(null as boolean) as is_salesperson,"
        " 'x' as phone_number, 'y' as email_address"
    )
    assert roles.dim_contact_person(people, include_rest=True).columns == [
        "contact_person_key", "contact_full_name", "contact_preferred_name",
        "contact_phone_number", "contact_email_address", "is_system_user", "is_employee",
        "is_salesperson",
    ]
    assert roles.dim_salesperson_person(people).count() == 0


def test_raw_layer_meets_its_contracts(spark):
    raw = RawLayer(spark, SF_DIR)
    assert sorted(raw) == sorted(contracts.RAW_TABLES)
    for table, df in raw.items():
        found = [(c.name, c.dataType) for c in df.schema.fields]
        assert found == [(c.name, c.dataType) for c in contracts.contract(table).fields]


def test_staging_reads_every_raw_table():
    assert sorted(table for table, _ in STAGING.values()) == sorted(contracts.RAW_TABLES)


def test_conform_reads_text_keys_and_number_flags(spark):
    one = {c.name: F.lit(None).cast("string") for c in contracts.contract("sales__Customers").fields}
    given = {
        "CustomerID": F.lit("5"),
        "BuyingGroupID": F.lit("NULL"),
        "AlternateContactPersonID": F.lit(""),
        "CreditLimit": F.lit("12.50"),
        "IsOnCreditHold": F.lit(1),
    }
    df = spark.range(1).select(*[v.alias(n) for n, v in (one | given).items()], F.lit(1).alias("Extra"))
    row = contracts.conform(df, "sales__Customers").first()
    assert row["CustomerID"] == 5 and row["BuyingGroupID"] is None
    assert row["AlternateContactPersonID"] is None and str(row["CreditLimit"]) == "12.50"
    assert row["IsOnCreditHold"] is True and "Extra" not in row


def test_a_number_that_does_not_fit_raises(spark):
    df = spark.sql("select 99999999999 as ColorID, 'red' as ColorName")
    with pytest.raises(PySparkException, match="CAST_OVERFLOW"):
        contracts.conform(df, "warehouse__Colors").collect()


@pytest.mark.parametrize("model", ["stg_sales_customer", "stg_sales_order_line"])
def test_staging_reads_an_untyped_export(spark, model):
    raw = RawLayer(spark, SF_DIR)
    table = STAGING[model][0]
    at = Context.loaded_at()
    typed = stage(raw, model, at)
    untyped = stage({table: contracts.as_text(raw[table])}, model, at)
    assert untyped.dtypes == typed.dtypes
    assert untyped.exceptAll(typed).count() == 0 and typed.exceptAll(untyped).count() == 0


def test_partitioned_mart_keeps_its_columns_and_is_pruned(spark, store):
    mart_table = Context(spark, SF_DIR).mart
    by = ["order_date_fiscal_year"]
    parts = store.materialize(mart_table, "mart_sales_order_line", partition_by=by)
    assert parts.columns == mart_table.columns
    year = parts.filter("order_date_fiscal_year = 2001")
    assert year.count() == mart_table.filter("order_date_fiscal_year = 2001").count() > 0
    assert "PartitionFilters: [isnotnull(order_date_fiscal_year" in (
        year._jdf.queryExecution().executedPlan().toString()
    )


def test_contract_report_counts_what_would_be_lost(spark):
    df = spark.sql("select * from values ('1', 'red'), ('x', null), (null, 'blue') as t(ColorID, Name)")
    report = contracts.contract_report(df, "warehouse__Colors")
    assert rows(report) == [
        ("warehouse__Colors", "ColorID", "int", "string", 3, 1, 1),
        ("warehouse__Colors", "ColorName", "string", None, 3, None, None),
    ]


def test_type_rules(spark):
    df = spark.sql(
        "select cast(1.5 as double) as d, cast(2.25 as float) as f, cast(3.10 as decimal(9,2)) as n,"
        " array(1, 2) as a"
    )
    kept = coercion.adapt_types(df, coercion.doubles_as_double)
    assert kept.schema == df.schema
    exact = coercion.adapt_types(df, coercion.floats_as_decimal(10, 3))
    assert [str(v) for v in exact.first()[:3]] == ["1.500", "2.250", "3.10"]
    rule = coercion.chain(coercion.arrays_as_json, coercion.decimals_as_text)
    texts = coercion.adapt_types(df, rule)
    assert texts.first()[2:] == ("3.10", "[1,2]")
    assert texts.schema["a"].dataType == T.StringType()


def test_table_callback_leaves_other_tables_alone(spark):
    df = spark.range(1).withColumn("props", F.lit(1))
    without = coercion.drop_column("events", "props")
    assert coercion.adapt_table(df, "events", without).columns == ["id"]
    assert coercion.adapt_table(df, "other", without).columns == ["id", "props"]
