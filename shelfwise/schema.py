"""Typed star schema: columns, keys, references and value rules of the twelve tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(14, 2)
PRICE = T.DecimalType(12, 2)
STOCK_VALUE = T.DecimalType(18, 2)

# Table layouts of the star. "!" marks a required column. Keys that grow with the business and stock
# positions are 64 bit, so the layout holds for billions of products or units; a stock value of 18 digits still fits a long.
TABLES: dict[str, str] = {
    "dim_date": """
        date_key int!, full_date date!, day_of_week int!, day_name string!, is_weekend boolean!,
        week_of_year int!, month_number int!, month_name string!, quarter int!, year int!,
        fiscal_year int!, fiscal_quarter string!, season string!, is_holiday boolean!, holiday_name string""",
    "dim_product": """
        product_key bigint!, sku string!, product_name string!, category string!, subcategory string!,
        brand string, unit_cost decimal(12,2)!, unit_price decimal(12,2)!, standard_margin_pct decimal(5,2),
        abc_class string, xyz_class string, launch_date date, discontinue_date date, is_active boolean!""",
    "dim_supplier": """
        supplier_key bigint!, supplier_id string!, supplier_name string!, country string, region string,
        category_specialisation string, reliability_tier string, contract_start_date date, is_active boolean!""",
    "dim_location": """
        location_key int!, location_id string!, location_type string!, location_name string!, region string!,
        city string, state string, store_size_sqft int, store_format string, warehouse_capacity_units int,
        open_date date, is_active boolean!""",
    "dim_customer": """
        customer_key bigint!, customer_id string!, loyalty_tier string, is_loyalty_member boolean!,
        region string, signup_date date""",
    "dim_employee": """
        employee_key int!, employee_id string!, employee_name string, role string,
        home_location_key int, hire_date date, is_active boolean!""",
    "dim_promotion": """
        promotion_key int!, promotion_id string!, promotion_name string, promotion_type string,
        discount_pct decimal(5,2), applies_to_level string, start_date date, end_date date, is_active boolean!""",
    "fact_sales": """
        sales_key bigint!, order_id string!, date_key int!, product_key bigint!, location_key int!,
        customer_key bigint, employee_key int, promotion_key int, units_sold_qty int!, unit_price decimal(12,2),
        gross_sales_amount decimal(14,2), discount_amount decimal(14,2), net_sales_amount decimal(14,2),
        unit_cost decimal(12,2), cogs_amount decimal(14,2), gross_margin_amount decimal(14,2)""",
    "fact_inventory_snapshot": """
        snapshot_key bigint!, snapshot_date_key int!, product_key bigint!, location_key int!, on_hand_qty bigint!,
        on_hand_value decimal(18,2), on_order_qty bigint, reorder_point int, safety_stock_qty int,
        days_of_supply decimal(8,2), is_below_reorder_flag boolean, is_stockout_flag boolean""",
    "fact_purchase_order": """
        po_line_key bigint!, po_number string!, order_date_key int!, expected_date_key int,
        received_date_key int, product_key bigint!, supplier_key bigint!, dest_location_key int!, ordered_qty int!,
        received_qty int, unit_cost decimal(12,2), po_line_amount decimal(14,2), lead_time_days int,
        is_late_flag boolean, is_complete_flag boolean, is_otif_flag boolean""",
    "fact_returns": """
        return_key bigint!, return_id string!, return_date_key int!, product_key bigint!, location_key int!,
        customer_key bigint, original_order_id string, returned_qty int!, refund_amount decimal(14,2),
        return_reason_code string""",
    "fact_stock_transfer": """
        transfer_key bigint!, transfer_id string!, transfer_date_key int!, product_key bigint!,
        source_location_key int!, dest_location_key int!, transfer_qty int!, transfer_cost decimal(14,2)""",
}

# Primary keys (one row per key).
PRIMARY_KEY: dict[str, tuple[str, ...]] = {
    "dim_date": ("date_key",),
    "dim_product": ("product_key",),
    "dim_supplier": ("supplier_key",),
    "dim_location": ("location_key",),
    "dim_customer": ("customer_key",),
    "dim_employee": ("employee_key",),
    "dim_promotion": ("promotion_key",),
    "fact_sales": ("sales_key",),
    "fact_inventory_snapshot": ("snapshot_key", "snapshot_date_key"),
    "fact_purchase_order": ("po_line_key",),
    "fact_returns": ("return_key",),
    "fact_stock_transfer": ("transfer_key",),
}

# Natural keys (unique next to the surrogate key).
NATURAL_KEY: dict[str, str] = {
    "dim_product": "sku",
    "dim_supplier": "supplier_id",
    "dim_location": "location_id",
    "dim_customer": "customer_id",
    "dim_employee": "employee_id",
    "dim_promotion": "promotion_id",
}

# References (table, column) -> dimension; the dimension side is its primary key.
REFERENCES: dict[str, dict[str, str]] = {
    "dim_employee": {"home_location_key": "dim_location"},
    "fact_sales": {
        "date_key": "dim_date",
        "product_key": "dim_product",
        "location_key": "dim_location",
        "customer_key": "dim_customer",
        "employee_key": "dim_employee",
        "promotion_key": "dim_promotion",
    },
    "fact_inventory_snapshot": {
        "snapshot_date_key": "dim_date",
        "product_key": "dim_product",
        "location_key": "dim_location",
    },
    "fact_purchase_order": {
        "order_date_key": "dim_date",
        "expected_date_key": "dim_date",
        "received_date_key": "dim_date",
        "product_key": "dim_product",
        "supplier_key": "dim_supplier",
        "dest_location_key": "dim_location",
    },
    "fact_returns": {
        "return_date_key": "dim_date",
        "product_key": "dim_product",
        "location_key": "dim_location",
        "customer_key": "dim_customer",
    },
    "fact_stock_transfer": {
        "transfer_date_key": "dim_date",
        "product_key": "dim_product",
        "source_location_key": "dim_location",
        "dest_location_key": "dim_location",
    },
}

# Month columns the two big facts are partitioned by (date key div 100).
PARTITION_COLUMN = {"fact_sales": ("sale_month", "date_key"),
                    "fact_inventory_snapshot": ("snapshot_month", "snapshot_date_key")}


_ATOMIC = {"int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(),
           "boolean": T.BooleanType(), "date": T.DateType()}


def _type(kind: str) -> T.DataType:
    if kind.startswith("decimal"):
        precision, scale = kind[len("decimal("):-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _ATOMIC[kind]


def _parse(layout: str) -> T.StructType:
    schema = T.StructType()
    # commas inside decimal(p,s) carry no blank, those between columns do
    for item in " ".join(layout.split()).split(", "):
        name, kind = item.rstrip("!").split(" ")
        schema = schema.add(name, _type(kind), nullable=not item.endswith("!"))
    return schema


SCHEMAS: dict[str, T.StructType] = {name: _parse(layout) for name, layout in TABLES.items()}
REQUIRED: dict[str, list[str]] = {
    name: [f.name for f in s.fields if not f.nullable] for name, s in SCHEMAS.items()
}


def stored_schema(table: str) -> T.StructType:
    """Schema as stored in Parquet: the contract columns plus the month partition column."""
    schema = T.StructType(list(SCHEMAS[table].fields))
    if table in PARTITION_COLUMN:
        schema = schema.add(PARTITION_COLUMN[table][0], T.IntegerType())
    return schema
