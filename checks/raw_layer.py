"""The 15 raw tables as SQL over the given test tables, for Spark and for DuckDB.

``{name}`` stands for a given table: Spark fills in a DataFrame, the SQL side the
name of the view. ``{five_regions}`` makes one row per region key out of a nation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

RAW_SQL: dict[str, str] = {
    "application__Countries": """
        select r_regionkey as CountryID, r_name as CountryName,
            'Region of ' || r_name as FormalName,
            case when r_regionkey % 2 = 0 then 'UN Member State' else 'Territory' end
                as CountryType,
            cast((r_regionkey + 1) * 1000000 as bigint) as LatestRecordedPopulation
        from {region}""",
    "application__StateProvinces": """
        select n_nationkey as StateProvinceID,
            'N' || lpad(cast(n_nationkey as string), 2, '0') as StateProvinceCode,
            n_name as StateProvinceName, n_regionkey as CountryID,
            cast((n_nationkey + 1) * 10000 as bigint) as LatestRecordedPopulation
        from {nation}""",
    "application__Cities": """
        select n_nationkey * 5 + r_regionkey as CityID,
            'City ' || n_name || '-' || cast(r_regionkey as string) as CityName,
            n_nationkey as StateProvinceID, cast(null as string) as Location
        from (select n_nationkey, n_name, {five_regions} as r_regionkey from {nation}) as n""",
    "application__DeliveryMethods": """
        select r_regionkey as DeliveryMethodID, 'Via ' || r_name as DeliveryMethodName
        from {region}""",
    "application__People": """
        select s_suppkey as PersonID, s_name as FullName,
            'S' || cast(s_suppkey as string) as PreferredName,
            s_suppkey % 5 = 0 as IsSystemUser, true as IsEmployee,
            s_suppkey % 2 = 0 as IsSalesperson, cast(null as string) as PhoneNumber,
            's' || cast(s_suppkey as string) || '@example.com' as EmailAddress
        from {supplier}
        union all
        select 1000000 + c_custkey, c_name, 'C' || cast(c_custkey as string), false, false, false,
            '555-' || lpad(cast(c_custkey as string), 7, '0'),
            'c' || cast(c_custkey as string) || '@example.com'
        from {customer}""",
    "purchasing__Suppliers": """
        select s_suppkey as SupplierID, s_name as SupplierName,
            s_suppkey % 3 as SupplierCategoryID, s_nationkey * 5 as PostalCityID
        from {supplier}""",
    "purchasing__SupplierCategories": """
        select r_regionkey as SupplierCategoryID, r_name as SupplierCategoryName
        from {region} where r_regionkey < 3""",
    "sales__BuyingGroups": """
        select r_regionkey as BuyingGroupID, 'Group ' || r_name as BuyingGroupName
        from {region} where r_regionkey < 3""",
    "sales__CustomerCategories": """
        select distinct ascii(c_mktsegment) as CustomerCategoryID,
            c_mktsegment as CustomerCategoryName
        from {customer}""",
    "sales__Customers": """
        select c_custkey as CustomerID, c_name as CustomerName,
            c_custkey - c_custkey % 3 as BillToCustomerID,
            ascii(c_mktsegment) as CustomerCategoryID,
            case when c_custkey % 4 < 3 then c_custkey % 4 end as BuyingGroupID,
            1000000 + c_custkey as PrimaryContactPersonID,
            case when c_custkey % 3 = 0 then 1000000 + c_custkey + 1 end
                as AlternateContactPersonID,
            c_custkey % 5 as DeliveryMethodID, c_nationkey * 5 + c_custkey % 5 as DeliveryCityID,
            c_nationkey * 5 + c_custkey % 7 as PostalCityID,
            case when c_acctbal > 0 then cast(c_acctbal as decimal(18,2)) end as CreditLimit,
            cast(c_custkey % 4 as double) as StandardDiscountPercentage,
            c_acctbal < 0 as IsOnCreditHold, 7 as PaymentDays,
            '555-' || lpad(cast(c_custkey as string), 7, '0') as PhoneNumber,
            'http://c' || cast(c_custkey as string) || '.example.com' as WebsiteURL,
            'Suite ' || cast(c_custkey as string) as DeliveryAddressLine1,
            case when c_custkey % 5 > 0 then c_mktsegment || ' Road' end as DeliveryAddressLine2,
            lpad(cast(c_custkey % 90000 as string), 5, '0') as DeliveryPostalCode,
            cast(null as string) as DeliveryLocation,
            'PO Box ' || cast(c_custkey as string) as PostalAddressLine1,
            case when c_custkey % 6 > 0 then c_mktsegment || ' Lane' end as PostalAddressLine2,
            lpad(cast(c_custkey % 80000 as string), 5, '0') as PostalPostalCode
        from {customer}""",
    "sales__Orders": """
        select o_orderkey as OrderID, o_custkey as CustomerID,
            o_orderkey % 10 as SalespersonPersonID,
            case when o_orderstatus <> 'O' then o_orderkey % 13 end as PickedByPersonID,
            1000000 + o_custkey as ContactPersonID,
            case when o_orderstatus = 'P' then o_orderkey + 1 end as BackorderOrderID,
            cast(o_orderdate as date) as OrderDate,
            cast(o_orderdate as date) + cast(o_orderkey % 10 as int) as ExpectedDeliveryDate,
            o_orderstatus = 'P' as IsUndersupplyBackordered,
            case when o_orderstatus = 'F' then o_orderdate end as PickingCompletedWhen
        from {orders}""",
    "sales__OrderLines": """
        select ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey
                as OrderLineID,
            l_orderkey as OrderID, l_partkey as StockItemID, l_linenumber as PackageTypeID,
            cast(l_quantity as int) as Quantity,
            cast(l_extendedprice as decimal(18,2)) as UnitPrice,
            cast(l_tax * 100 as decimal(18,3)) as TaxRate,
            case when l_linestatus = 'F' then cast(l_quantity as int) else 0 end
                as PickedQuantity,
            case when l_linestatus = 'F' then l_shipdate end as PickingCompletedWhen
        from {lineitem}""",
    "warehouse__Colors": """
        select r_regionkey as ColorID, lower(r_name) as ColorName from {region}""",
    "warehouse__PackageTypes": """
        select distinct l_linenumber as PackageTypeID,
            'Package ' || cast(l_linenumber as string) as PackageTypeName
        from {lineitem} where l_linenumber <= 6""",
    "warehouse__StockItems": """
        select p_partkey as StockItemID, p_name as StockItemName, p_partkey % 11 as SupplierID,
            case when p_partkey % 6 < 5 then p_partkey % 6 end as ColorID,
            cast(p_partkey % 7 + 1 as int) as UnitPackageID,
            cast(p_partkey % 6 + 1 as int) as OuterPackageID, p_brand as Brand,
            cast(p_size as string) as Size, cast(p_partkey % 14 as int) as LeadTimeDays,
            cast(p_partkey % 12 + 1 as int) as QuantityPerOuter,
            p_type = 'SMALL' as IsChillerStock, cast(15.0 as decimal(18,3)) as TaxRate,
            cast(p_retailprice as decimal(18,2)) as UnitPrice,
            cast(p_retailprice * 1.5 as decimal(18,2)) as RecommendedRetailPrice,
            cast(p_size as decimal(18,3)) as TypicalWeightPerUnit
        from {part}""",
}

FIVE_REGIONS = {"spark": "explode(sequence(0, 4))", "duckdb": "unnest([0, 1, 2, 3, 4])"}


def given_tables(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)) - {"five_regions"})


def duckdb_sql(table: str) -> str:
    """The raw table as SQL over the driver's views."""
    names = {name: name for name in given_tables(RAW_SQL[table])}
    return RAW_SQL[table].format(five_regions=FIVE_REGIONS["duckdb"], **names).strip()


def read_given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class RawLayer(Mapping):
    """Raw tables as lazy DataFrames, each planned when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._planned: dict[str, DataFrame] = {}
        self._given: dict[str, DataFrame] = {}

    def given(self, table: str) -> DataFrame:
        if table not in self._given:
            self._given[table] = read_given(self.spark, self.sf_dir, table)
        return self._given[table]

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._planned:
            sql = RAW_SQL[table].replace("{five_regions}", FIVE_REGIONS["spark"])
            given = {name: self.given(name) for name in given_tables(sql)}
            self._planned[table] = self.spark.sql(sql, **given)
        return self._planned[table]

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_SQL)

    def __len__(self) -> int:
        return len(RAW_SQL)
