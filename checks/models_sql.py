"""The warehouse models as SQL, for comparing Spark's results with another engine.

Every entry is a named ``with`` step; :func:`compose` puts the steps a query needs
in front of it. Raw steps come from :mod:`checks.raw_layer`.
"""

from __future__ import annotations

import re

from checks.raw_layer import RAW_SQL, duckdb_sql

# The load stamp that queries and SQL share, so that results can be compared.
LOADED_AT = "2024-02-01 00:00:00"
STAMP = f"timestamp '{LOADED_AT}' as processed_at"

STEPS: dict[str, str] = {
    "stg_application_city": """
        select CityID as city_key, CityName as city_name, StateProvinceID as state_province_key,
            Location as location_key
        from application__Cities""",
    "stg_application_country": """
        select CountryID as country_key, CountryName as country_name,
            FormalName as country_formal_name, CountryType as country_type,
            LatestRecordedPopulation as latest_recored_population
        from application__Countries""",
    "stg_application_delivery_method": """
        select DeliveryMethodID as delivery_method_key, DeliveryMethodName as delivery_method_name
        from application__DeliveryMethods""",
    "stg_application_person": f"""
        select PersonID as person_key, FullName as person_full_name,
            PreferredName as person_preferred_name, IsSystemUser as is_system_user,
            IsEmployee as is_employee, IsSalesperson as is_salesperson,
            PhoneNumber as phone_number, EmailAddress as email_address, {STAMP}
        from application__People""",
    "stg_application_state_province": """
        select StateProvinceID as state_province_key, StateProvinceCode as state_province_code,
            StateProvinceName as state_province_name, CountryID as country_key,
            LatestRecordedPopulation as latest_recored_population
        from application__StateProvinces""",
    "stg_purchasing_supplier": """
        select SupplierID as supplier_key, SupplierName as supplier_name,
            SupplierCategoryID as supplier_category_key, PostalCityID as postal_city_key
        from purchasing__Suppliers""",
    "stg_purchasing_supplier_category": """
        select SupplierCategoryID as supplier_category_key,
            SupplierCategoryName as supplier_category_name
        from purchasing__SupplierCategories""",
    "stg_sales_buying_group": """
        select BuyingGroupID as buying_group_key, BuyingGroupName as buying_group_name
        from sales__BuyingGroups""",
    "stg_sales_customer": f"""
        select CustomerID as customer_key, CustomerName as customer_name,
            BillToCustomerID as bill_to_customer_key,
            CustomerCategoryID as customer_category_key, BuyingGroupID as buying_group_key,
            PrimaryContactPersonID as primary_contact_person_key,
            AlternateContactPersonID as alternate_contact_person_key,
            DeliveryMethodID as delivery_method_key, DeliveryCityID as delivery_city_key,
            PostalCityID as postal_city_key, CreditLimit as credit_limit,
            StandardDiscountPercentage as standard_discount_percentage,
            IsOnCreditHold as is_on_credit_hold, PaymentDays as payment_term_days,
            PhoneNumber as phone_number, WebsiteURL as website_url,
            DeliveryAddressLine1 as delivery_address_line_1,
            DeliveryAddressLine2 as delivery_address_line_2,
            DeliveryPostalCode as delivery_postal_code, DeliveryLocation as delivery_location,
            PostalAddressLine1 as postal_address_line_1,
            PostalAddressLine2 as postal_address_line_2,
            PostalPostalCode as postal_postal_code, {STAMP}
        from sales__Customers""",
    "stg_sales_customer_category": """
        select CustomerCategoryID as customer_category_key,
            CustomerCategoryName as customer_category_name
        from sales__CustomerCategories""",
    "stg_sales_order": f"""
        select OrderID as order_key, CustomerID as customer_key,
            SalespersonPersonID as salesperson_key, PickedByPersonID as picked_by_person_key,
            ContactPersonID as contact_person_key, BackorderOrderID as backorder_order_key,
            OrderDate as order_date_key, ExpectedDeliveryDate as expected_delivery_date_key,
            IsUndersupplyBackordered as is_undersupply_backordered,
            PickingCompletedWhen as picking_completed_date_key, {STAMP}
        from sales__Orders""",
    "stg_sales_order_line": f"""
        select OrderLineID as order_line_key, OrderID as order_key,
            StockItemID as stock_item_key, PackageTypeID as package_type_key,
            Quantity as quantity, UnitPrice as unit_price, TaxRate as tax_rate,
            PickedQuantity as picked_quantity,
            PickingCompletedWhen as picking_completed_date_key, {STAMP}
        from sales__OrderLines""",
    "stg_warehouse_color": """
        select ColorID as color_key, ColorName as color_name from warehouse__Colors""",
    "stg_warehouse_package_type": """
        select PackageTypeID as package_type_key, PackageTypeName as package_type_name
        from warehouse__PackageTypes""",
    "stg_warehouse_stock_item": """
        select StockItemID as stock_item_key, StockItemName as stock_item_name,
            SupplierID as supplier_key, ColorID as color_key,
            UnitPackageID as unit_package_type_key, OuterPackageID as outer_package_type_key,
            Brand as brand, Size as size, LeadTimeDays as lead_time_days,
            QuantityPerOuter as quantiy_per_outer, IsChillerStock as is_chiller_stock,
            TaxRate as tax_rate, UnitPrice as unit_price,
            RecommendedRetailPrice as recommended_retail_price,
            TypicalWeightPerUnit as typical_weight_per_unit
        from warehouse__StockItems""",
    "city_flat": """
        select ci.city_key, ci.city_name, ci.state_province_key, sp.state_province_name,
            sp.latest_recored_population as state_province_population, sp.country_key,
            co.country_name, co.country_formal_name, co.country_type,
            co.latest_recored_population as country_population
        from stg_application_city ci
        left join stg_application_state_province sp using (state_province_key)
        left join stg_application_country co on co.country_key = sp.country_key""",
    "dim_customer": """
        select cu.customer_key, cu.customer_name, cu.bill_to_customer_key,
            cc.customer_category_name, cu.buying_group_key, bg.buying_group_name,
            p1.person_full_name as primary_contact_full_name,
            p1.is_system_user as primary_contact_is_system_user,
            p1.is_employee as primary_contact_is_employee,
            p1.is_salesperson as primary_contact_is_salesperson,
            p1.phone_number as primary_contact_phone_number,
            p1.email_address as primary_contact_email_address,
            p2.person_full_name as alternate_contact_full_name,
            dm.delivery_method_name, cu.delivery_city_key,
            dc.city_name as delivery_city_name,
            dc.state_province_name as delivery_state_province_name,
            dc.state_province_population as delivery_state_province_population,
            dc.country_name as delivery_country_name,
            dc.country_formal_name as delivery_country_formal_name,
            dc.country_type as delivery_country_type,
            dc.country_population as delivery_country_population,
            cu.postal_city_key, cu.credit_limit, cu.standard_discount_percentage,
            cu.is_on_credit_hold, cu.payment_term_days, cu.phone_number, cu.website_url,
            cu.delivery_address_line_1 || ' ' || cu.delivery_address_line_2 as delivery_address,
            cu.delivery_postal_code, cu.delivery_location,
            cu.postal_address_line_1 || ' ' || cu.postal_address_line_2 as postal_address,
            cu.postal_postal_code
        from stg_sales_customer cu
        left join stg_sales_customer_category cc
            on cc.customer_category_key = cu.customer_category_key
        left join stg_sales_buying_group bg on bg.buying_group_key = cu.buying_group_key
        left join stg_application_person p1 on p1.person_key = cu.primary_contact_person_key
        left join stg_application_person p2 on p2.person_key = cu.alternate_contact_person_key
        left join stg_application_delivery_method dm
            on dm.delivery_method_key = cu.delivery_method_key
        left join city_flat dc on dc.city_key = cu.delivery_city_key
        left join city_flat pc on pc.city_key = cu.postal_city_key""",
    "dim_package_type": """
        select package_type_key, package_type_name from stg_warehouse_package_type""",
    "dim_person": """
        select person_key, person_full_name, person_preferred_name, is_system_user, is_employee,
            is_salesperson, phone_number, email_address
        from stg_application_person""",
    "dim_stock_item": """
        select si.stock_item_key, si.stock_item_name, si.supplier_key, si.color_key,
            up.package_type_name as unit_package_type_name,
            op.package_type_name as outer_package_type_name,
            si.brand, si.size, si.lead_time_days, si.quantiy_per_outer, si.is_chiller_stock,
            si.tax_rate, si.unit_price, si.recommended_retail_price, si.typical_weight_per_unit,
            wc.color_name, su.supplier_name
        from stg_warehouse_stock_item si
        left join stg_warehouse_package_type up on up.package_type_key = si.unit_package_type_key
        left join stg_warehouse_package_type op on op.package_type_key = si.outer_package_type_key
        left join stg_warehouse_color wc on wc.color_key = si.color_key
        left join stg_purchasing_supplier su on su.supplier_key = si.supplier_key""",
    "line_with_order": """
        select ol.order_line_key as sales_order_line_key, ol.order_key as sales_order_key,
            ol.stock_item_key, ol.package_type_key, ol.quantity, ol.unit_price, ol.tax_rate,
            ol.picked_quantity,
            ol.picking_completed_date_key as sales_order_line_picking_completed_date_key,
            so.customer_key, so.salesperson_key, so.picked_by_person_key, so.contact_person_key,
            so.backorder_order_key, so.order_date_key, so.expected_delivery_date_key,
            so.is_undersupply_backordered,
            so.picking_completed_date_key as sales_order_picking_completed_date_key,
            ol.processed_at as sales_order_line_processed_at
        from stg_sales_order_line ol
        left join stg_sales_order so on so.order_key = ol.order_key""",
    "fact_sales_order_line": """
        select sales_order_line_key, sales_order_key, stock_item_key, package_type_key, quantity,
            unit_price, tax_rate, picked_quantity, customer_key, salesperson_key,
            picked_by_person_key, contact_person_key, backorder_order_key,
            is_undersupply_backordered, sales_order_line_processed_at,
            strftime(sales_order_line_picking_completed_date_key, '%Y%m%d')
                as sales_order_line_picking_completed_date_key,
            strftime(order_date_key, '%Y%m%d') as order_date_key,
            strftime(expected_delivery_date_key, '%Y%m%d') as expected_delivery_date_key,
            strftime(sales_order_picking_completed_date_key, '%Y%m%d')
                as sales_order_picking_completed_date_key
        from line_with_order""",
    "dim_date": """
        select strftime(d, '%Y%m%d') as date_key, d as full_date,
            cast(year(d) as int) as "year",
            cast(year(d) * 100 + cast(strftime(d, '%U') as int) as int) as year_week,
            cast(year(d) * 1000 + dayofyear(d) as int) as year_day,
            cast(case when month(d) >= 4 then year(d) + 1 else year(d) end as int) as fiscal_year,
            'Q' || cast(quarter(d) as varchar) as fiscal_qtr,
            cast(month(d) as int) as "month", monthname(d) as month_name,
            cast(dayofweek(d) + 1 as int) as week_day, dayname(d) as day_name,
            cast(case when dayofweek(d) in (0, 6) then 0 else 1 end as int) as day_is_weekday
        from (
            select cast(unnest(generate_series(
                date '2000-01-01', date '2050-12-31', interval 1 day)) as date) as d
        ) days""",
    "dim_contact_person": """
        select person_key as contact_person_key, person_full_name as contact_full_name,
            person_preferred_name as contact_preferred_name, is_system_user, is_employee,
            is_salesperson
        from dim_person""",
    "dim_picked_by_person": """
        select person_key as picked_by_person_key,
            person_full_name as picked_by_person_full_name,
            person_preferred_name as picked_by_picked_by_preferred_name, is_system_user,
            is_employee, is_salesperson
        from dim_person""",
    "dim_salesperson_person": """
        select person_key as salesperson_person_key,
            person_full_name as salesperson_full_name,
            person_preferred_name as salesperson_preferred_name, is_system_user, is_employee,
            is_salesperson
        from dim_person where is_salesperson = true""",
    "mart_sales_order_line": """
        select f.sales_order_line_key, f.sales_order_key, f.quantity, f.unit_price, f.tax_rate,
            f.picked_quantity, f.salesperson_key, f.backorder_order_key,
            f.is_undersupply_backordered, f.sales_order_line_processed_at,
            c.customer_name as customer_customer_name,
            c.customer_category_name as customer_customer_category_name,
            c.buying_group_name as customer_buying_group_name,
            c.primary_contact_full_name as customer_primary_contact_full_name,
            c.primary_contact_is_system_user as customer_primary_contact_is_system_user,
            c.primary_contact_is_employee as customer_primary_contact_is_employee,
            c.primary_contact_is_salesperson as customer_primary_contact_is_salesperson,
            c.primary_contact_phone_number as customer_primary_contact_phone_number,
            c.primary_contact_email_address as customer_primary_contact_email_address,
            c.alternate_contact_full_name as customer_alternate_contact_full_name,
            c.delivery_method_name as customer_delivery_method_name,
            c.delivery_city_name as customer_delivery_city_name,
            c.delivery_state_province_name as customer_delivery_state_province_name,
            c.delivery_state_province_population as customer_delivery_state_province_population,
            c.delivery_country_name as customer_delivery_country_name,
            c.delivery_country_formal_name as customer_delivery_country_formal_name,
            c.delivery_country_type as customer_delivery_country_type,
            c.delivery_country_population as customer_delivery_country_population,
            c.credit_limit as customer_credit_limit,
            c.standard_discount_percentage as customer_standard_discount_percentage,
            c.is_on_credit_hold as customer_is_on_credit_hold,
            c.payment_term_days as customer_payment_term_days,
            c.phone_number as customer_phone_number, c.website_url as customer_website_url,
            c.delivery_address as customer_delivery_address,
            c.delivery_postal_code as customer_delivery_postal_code,
            c.delivery_location as customer_delivery_location,
            c.postal_address as customer_postal_address,
            c.postal_postal_code as customer_postal_postal_code,
            b.customer_name as bill_to_customer_name,
            sp.person_full_name as salesperson_person_full_name,
            pk.person_full_name as picked_by_person_person_full_name,
            ct.person_full_name as contact_person_person_full_name,
            si.stock_item_name, si.color_name, si.supplier_name, si.is_chiller_stock,
            pt.package_type_name as package_type_package_type_name,
            {dates}
            d3.full_date as sales_order_picking_completed_date_full_date,
            d4.full_date as sales_order_line_picking_completed_date_full_date
        from fact_sales_order_line f
        left join dim_customer c on c.customer_key = f.customer_key
        left join dim_customer b on b.customer_key = c.bill_to_customer_key
        left join dim_person sp on sp.person_key = f.salesperson_key
        left join dim_person pk on pk.person_key = f.picked_by_person_key
        left join dim_person ct on ct.person_key = f.contact_person_key
        left join dim_stock_item si on si.stock_item_key = f.stock_item_key
        left join dim_package_type pt on pt.package_type_key = f.package_type_key
        left join dim_date d1 on d1.date_key = f.order_date_key
        left join dim_date d2 on d2.date_key = f.expected_delivery_date_key
        left join dim_date d3 on d3.date_key = f.sales_order_picking_completed_date_key
        left join dim_date d4
            on d4.date_key = f.sales_order_line_picking_completed_date_key""".replace(
        "{dates}",
        "\n            ".join(
            f'd1."{name}" as order_date_{name}, d2."{name}" as expected_delivery_date_{name},'
            for name in (
                "full_date",
                "year",
                "year_week",
                "year_day",
                "fiscal_year",
                "fiscal_qtr",
                "month",
                "month_name",
                "week_day",
                "day_name",
                "day_is_weekday",
            )
        ),
    ),
}


def step_sql(name: str) -> str:
    return (duckdb_sql(name) if name in RAW_SQL else STEPS[name]).strip()


def _mentioned(sql: str) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [name for name in (*RAW_SQL, *STEPS) if name in words]


def compose(body: str) -> str:
    """``body`` with every step it needs, directly or not, in front of it."""
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in _mentioned(sql):
            if name not in ordered:
                text = step_sql(name)
                need(text.replace(f"'{name}'", ""))
                if name not in ordered:
                    ordered.append(name)

    need(body)
    steps = ",\n".join(f"{name} as (\n{step_sql(name)}\n)" for name in ordered)
    return f"with {steps}\n{body.strip()}" if steps else body.strip()
