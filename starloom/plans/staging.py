"""Staging: pick and rename the raw columns, stamp the load time where asked."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame

from starloom.functions.columns import rename_select
from starloom.sources.contracts import conform
from starloom.sources.incremental import load_stamp

# Raw table and column names of each staging model, in output order.
STAGING: dict[str, tuple[str, dict[str, str]]] = {
    "stg_application_city": (
        "application__Cities",
        {
            "CityID": "city_key",
            "CityName": "city_name",
            "StateProvinceID": "state_province_key",
            "Location": "location_key",
        },
    ),
    "stg_application_country": (
        "application__Countries",
        {
            "CountryID": "country_key",
            "CountryName": "country_name",
            "FormalName": "country_formal_name",
            "CountryType": "country_type",
            "LatestRecordedPopulation": "latest_recored_population",
        },
    ),
    "stg_application_delivery_method": (
        "application__DeliveryMethods",
        {
            "DeliveryMethodID": "delivery_method_key",
            "DeliveryMethodName": "delivery_method_name",
        },
    ),
    "stg_application_person": (
        "application__People",
        {
            "PersonID": "person_key",
            "FullName": "person_full_name",
            "PreferredName": "person_preferred_name",
            "IsSystemUser": "is_system_user",
            "IsEmployee": "is_employee",
            "IsSalesperson": "is_salesperson",
            "PhoneNumber": "phone_number",
            "EmailAddress": "email_address",
        },
    ),
    "stg_application_state_province": (
        "application__StateProvinces",
        {
            "StateProvinceID": "state_province_key",
            "StateProvinceCode": "state_province_code",
            "StateProvinceName": "state_province_name",
            "CountryID": "country_key",
            "LatestRecordedPopulation": "latest_recored_population",
        },
    ),
    "stg_purchasing_supplier": (
        "purchasing__Suppliers",
        {
            "SupplierID": "supplier_key",
            "SupplierName": "supplier_name",
            "SupplierCategoryID": "supplier_category_key",
            "PostalCityID": "postal_city_key",
        },
    ),
    "stg_purchasing_supplier_category": (
        "purchasing__SupplierCategories",
        {
            "SupplierCategoryID": "supplier_category_key",
            "SupplierCategoryName": "supplier_category_name",
        },
    ),
    "stg_sales_buying_group": (
        "sales__BuyingGroups",
        {
            "BuyingGroupID": "buying_group_key",
            "BuyingGroupName": "buying_group_name",
        },
    ),
    "stg_sales_customer": (
        "sales__Customers",
        {
            "CustomerID": "customer_key",
            "CustomerName": "customer_name",
            "BillToCustomerID": "bill_to_customer_key",
            "CustomerCategoryID": "customer_category_key",
            "BuyingGroupID": "buying_group_key",
            "PrimaryContactPersonID": "primary_contact_person_key",
            "AlternateContactPersonID": "alternate_contact_person_key",
            "DeliveryMethodID": "delivery_method_key",
            "DeliveryCityID": "delivery_city_key",
            "PostalCityID": "postal_city_key",
            "CreditLimit": "credit_limit",
            "StandardDiscountPercentage": "standard_discount_percentage",
            "IsOnCreditHold": "is_on_credit_hold",
            "PaymentDays": "payment_term_days",
            "PhoneNumber": "phone_number",
            "WebsiteURL": "website_url",
            "DeliveryAddressLine1": "delivery_address_line_1",
            "DeliveryAddressLine2": "delivery_address_line_2",
            "DeliveryPostalCode": "delivery_postal_code",
            "DeliveryLocation": "delivery_location",
            "PostalAddressLine1": "postal_address_line_1",
            "PostalAddressLine2": "postal_address_line_2",
            "PostalPostalCode": "postal_postal_code",
        },
    ),
    "stg_sales_customer_category": (
        "sales__CustomerCategories",
        {
            "CustomerCategoryID": "customer_category_key",
            "CustomerCategoryName": "customer_category_name",
        },
    ),
    "stg_sales_order": (
        "sales__Orders",
        {
            "OrderID": "order_key",
            "CustomerID": "customer_key",
            "SalespersonPersonID": "salesperson_key",
            "PickedByPersonID": "picked_by_person_key",
            "ContactPersonID": "contact_person_key",
            "BackorderOrderID": "backorder_order_key",
            "OrderDate": "order_date_key",
            "ExpectedDeliveryDate": "expected_delivery_date_key",
            "IsUndersupplyBackordered": "is_undersupply_backordered",
            "PickingCompletedWhen": "picking_completed_date_key",
        },
    ),
    "stg_sales_order_line": (
        "sales__OrderLines",
        {
            "OrderLineID": "order_line_key",
            "OrderID": "order_key",
            "StockItemID": "stock_item_key",
            "PackageTypeID": "package_type_key",
            "Quantity": "quantity",
            "UnitPrice": "unit_price",
            "TaxRate": "tax_rate",
            "PickedQuantity": "picked_quantity",
            "PickingCompletedWhen": "picking_completed_date_key",
        },
    ),
    "stg_warehouse_color": (
        "warehouse__Colors",
        {
            "ColorID": "color_key",
            "ColorName": "color_name",
        },
    ),
    "stg_warehouse_package_type": (
        "warehouse__PackageTypes",
        {
            "PackageTypeID": "package_type_key",
            "PackageTypeName": "package_type_name",
        },
    ),
    "stg_warehouse_stock_item": (
        "warehouse__StockItems",
        {
            "StockItemID": "stock_item_key",
            "StockItemName": "stock_item_name",
            "SupplierID": "supplier_key",
            "ColorID": "color_key",
            "UnitPackageID": "unit_package_type_key",
            "OuterPackageID": "outer_package_type_key",
            "Brand": "brand",
            "Size": "size",
            "LeadTimeDays": "lead_time_days",
            "QuantityPerOuter": "quantiy_per_outer",
            "IsChillerStock": "is_chiller_stock",
            "TaxRate": "tax_rate",
            "UnitPrice": "unit_price",
            "RecommendedRetailPrice": "recommended_retail_price",
            "TypicalWeightPerUnit": "typical_weight_per_unit",
        },
    ),
}

# Models that carry the load stamp.
STAMPED = (
    "stg_application_person",
    "stg_sales_customer",
    "stg_sales_order",
    "stg_sales_order_line",
)


def stage(raw: Mapping[str, DataFrame], model: str, loaded_at: Column | None = None) -> DataFrame:
    """One staging view; ``loaded_at`` defaults to the time of the query.

    Raw columns that arrive in another type than the contract's, such as keys and
    flags exported as text, are cast here.
    """
    table, names = STAGING[model]
    renamed = rename_select(conform(raw[table], table), names)
    return load_stamp(renamed, loaded_at) if model in STAMPED else renamed


class StagingViews(Mapping):
    """All staging views by name, each planned when first asked for."""

    def __init__(self, raw: Mapping[str, DataFrame], loaded_at: Column | None = None):
        self._raw = raw
        self._loaded_at = loaded_at
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, model: str) -> DataFrame:
        if model not in self._planned:
            self._planned[model] = stage(self._raw, model, self._loaded_at)
        return self._planned[model]

    def __iter__(self) -> Iterator[str]:
        return iter(STAGING)

    def __len__(self) -> int:
        return len(STAGING)
