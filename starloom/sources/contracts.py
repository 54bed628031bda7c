"""Column contracts of the 15 raw tables, and the checks made against them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw table names, column names and types.
RAW_TABLES: dict[str, str] = {
    "application__Cities": "CityID int, CityName string, StateProvinceID int, Location string",
    "application__Countries": (
        "CountryID int, CountryName string, FormalName string, CountryType string,"
        " LatestRecordedPopulation bigint"
    ),
    "application__DeliveryMethods": "DeliveryMethodID int, DeliveryMethodName string",
    "application__People": (
        "PersonID bigint, FullName string, PreferredName string, IsSystemUser boolean,"
        " IsEmployee boolean, IsSalesperson boolean, PhoneNumber string, EmailAddress string"
    ),
    "application__StateProvinces": (
        "StateProvinceID int, StateProvinceCode string, StateProvinceName string,"
        " CountryID int, LatestRecordedPopulation bigint"
    ),
    "purchasing__SupplierCategories": "SupplierCategoryID int, SupplierCategoryName string",
    "purchasing__Suppliers": (
        "SupplierID bigint, SupplierName string, SupplierCategoryID bigint, PostalCityID int"
    ),
    "sales__BuyingGroups": "BuyingGroupID int, BuyingGroupName string",
    "sales__CustomerCategories": "CustomerCategoryID int, CustomerCategoryName string",
    "sales__Customers": (
        "CustomerID bigint, CustomerName string, BillToCustomerID bigint,"
        " CustomerCategoryID int, BuyingGroupID bigint, PrimaryContactPersonID bigint,"
        " AlternateContactPersonID bigint, DeliveryMethodID bigint, DeliveryCityID bigint,"
        " PostalCityID bigint, CreditLimit decimal(18,2), StandardDiscountPercentage double,"
        " IsOnCreditHold boolean, PaymentDays int, PhoneNumber string, WebsiteURL string,"
        " DeliveryAddressLine1 string, DeliveryAddressLine2 string, DeliveryPostalCode string,"
        " DeliveryLocation string, PostalAddressLine1 string, PostalAddressLine2 string,"
        " PostalPostalCode string"
    ),
    "sales__OrderLines": (
        "OrderLineID bigint, OrderID bigint, StockItemID bigint, PackageTypeID int,"
        " Quantity int, UnitPrice decimal(18,2), TaxRate decimal(18,3), PickedQuantity int,"
        " PickingCompletedWhen timestamp_ntz"
    ),
    "sales__Orders": (
        "OrderID bigint, CustomerID bigint, SalespersonPersonID bigint, PickedByPersonID bigint,"
        " ContactPersonID bigint, BackorderOrderID bigint, OrderDate date,"
        " ExpectedDeliveryDate date, IsUndersupplyBackordered boolean,"
        " PickingCompletedWhen timestamp_ntz"
    ),
    "warehouse__Colors": "ColorID int, ColorName string",
    "warehouse__PackageTypes": "PackageTypeID int, PackageTypeName string",
    "warehouse__StockItems": (
        "StockItemID bigint, StockItemName string, SupplierID bigint, ColorID bigint,"
        " UnitPackageID int, OuterPackageID int, Brand string, Size string, LeadTimeDays int,"
        " QuantityPerOuter int, IsChillerStock boolean, TaxRate decimal(18,3),"
        " UnitPrice decimal(18,2), RecommendedRetailPrice decimal(18,2),"
        " TypicalWeightPerUnit decimal(18,3)"
    ),
}


# How untyped exports spell a missing value.
MISSING = ("", "NULL", "\\N", "N/A", "NA", "NONE")


def contract(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_TABLES[table])


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the way an export without types delivers it."""
    return df.select(*[F.col(name).cast("string").alias(name) for name in df.columns])


def _conformed(column: T.StructField, found: T.DataType) -> Column:
    value = F.col(column.name)
    if isinstance(found, T.StringType):
        missing = F.upper(F.trim(value)).isin(*MISSING)
        unread = F.raise_error(
            F.concat(F.lit(f"{column.name} is no {column.dataType.simpleString()}: "), value)
        )
        read = value.try_cast(column.dataType)
        value = F.when(missing | value.isNull(), F.lit(None)).otherwise(
            F.coalesce(read, unread.cast(column.dataType))
        )
        return value.cast(column.dataType).alias(column.name)
    return value.cast(column.dataType).alias(column.name)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Pick the contract's columns and cast those of another type.

    Text that stands for a missing value (:data:`MISSING`) becomes NULL here and
    nowhere else. Any other text that does not parse raises, as does a number that
    does not fit; :func:`contract_report` counts such values beforehand.
    """
    found = {c.name: c.dataType for c in df.schema.fields}
    return df.select(
        *[
            F.col(c.name) if found[c.name] == c.dataType else _conformed(c, found[c.name])
            for c in contract(table).fields
        ]
    )


def contract_report(df: DataFrame, table: str) -> DataFrame:
    """One row per contract column: declared and found type, rows, NULLs, bad casts.

    A column the data lacks has no found type and no counts.
    """
    found = {c.name: c.dataType for c in df.schema.fields}
    measures = []
    for c in contract(table).fields:
        if c.name not in found:
            measures.append((c, None, F.lit(None).cast("long"), F.lit(None).cast("long")))
            continue
        value = F.col(c.name)
        lost = value.isNotNull() & value.try_cast(c.dataType).isNull()
        measures.append(
            (
                c,
                found[c.name].simpleString(),
                F.count(F.lit(1)) - F.count(value),
                F.count(F.when(lost, 1)),
            )
        )
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c.name).alias("column_name"),
                F.lit(c.dataType.simpleString()).alias("expected_type"),
                F.lit(actual).cast("string").alias("actual_type"),
                F.count(F.lit(1)).alias("row_count"),
                nulls.alias("null_count"),
                lost.alias("uncastable_count"),
            )
            for c, actual, nulls, lost in measures
        ]
    )
    return df.agg(rows.alias("report")).select(F.inline("report"))


def contract_reports(raw: Mapping[str, DataFrame]) -> DataFrame:
    """The report of every given raw table, one scan each."""
    reports = [contract_report(df, table) for table, df in raw.items()]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def schema_reflection(df: DataFrame, table: str) -> DataFrame:
    """Full-precision column types with the widths the data really uses."""
    rows = []
    for position, c in enumerate(df.schema.fields, start=1):
        kind = c.dataType
        decimal = isinstance(kind, T.DecimalType)
        longest = (
            F.max(F.char_length(F.col(c.name)))
            if isinstance(kind, T.StringType)
            else F.lit(None).cast("int")
        )
        rows.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(position).alias("ordinal_position"),
                F.lit(c.name).alias("column_name"),
                F.lit(kind.simpleString()).alias("data_type"),
                F.lit(kind.precision if decimal else None).cast("int").alias("numeric_precision"),
                F.lit(kind.scale if decimal else None).cast("int").alias("numeric_scale"),
                longest.alias("longest_text"),
                F.count(F.col(c.name)).alias("non_null_count"),
            )
        )
    return df.agg(F.array(*rows).alias("columns")).select(F.inline("columns"))
