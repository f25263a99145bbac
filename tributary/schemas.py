"""Table definitions."""

from pyspark.sql import types as T

NUMBER = T.DecimalType(38, 0)


STRING, NTZ = T.StringType(), T.TimestampNTZType()


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# The columns of the tables, in order.
RAW_ORDERS = _table(
    ("raw_data", T.VariantType()),
    ("ingested_at", NTZ),
    ("file_name", STRING),
    ("file_row_number", NUMBER),
    ("load_id", STRING),
)

DEAD_LETTER = _table(
    ("raw_data", T.VariantType()),
    ("error_reason", STRING),
    ("file_name", STRING),
    ("file_row_number", NUMBER),
    ("rejected_at", NTZ),
)

STG_ORDERS = _table(
    ("order_id", STRING),
    ("order_date", NTZ),
    ("order_status", STRING),
    ("customer_id", STRING),
    ("customer_name", STRING),
    ("customer_region", STRING),
    ("customer_segment", STRING),
    ("supplier_id", STRING),
    ("supplier_name", STRING),
    ("supplier_country", STRING),
    ("lead_time_days", NUMBER),
    ("performance_score", T.DoubleType()),
    ("shipment_id", STRING),
    ("carrier", STRING),
    ("ship_date", NTZ),
    ("estimated_delivery", T.DateType()),
    ("delay_days", NUMBER),
    ("product_id", STRING),
    ("product_name", STRING),
    ("category", STRING),
    ("quantity", NUMBER),
    ("unit_price", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("payment_status", STRING),
    ("warehouse_id", STRING),
    ("warehouse_location", STRING),
    ("inventory_level", NUMBER),
    ("file_name", STRING),
    ("file_row_number", NUMBER),
    ("ingested_at", NTZ),
    ("transformed_at", NTZ),
)

LOAD_HISTORY = _table(
    ("table_name", STRING),
    ("file_name", STRING),
    ("file_size", T.LongType()),
    ("last_load_time", NTZ),
    ("row_count", T.LongType()),
    ("row_parsed", T.LongType()),
    ("first_error", STRING),
    ("status", STRING),
)

# Columns that are filled when a row leaves them out.
DEFAULTS = {
    "raw_orders": {"ingested_at": "localtimestamp()"},
    "dead_letter": {"rejected_at": "localtimestamp()"},
    "stg_orders": {"transformed_at": "localtimestamp()"},
}


def columns_ddl(table: str, schema: T.StructType) -> str:
    """The columns of a table with their defaults, as DDL."""
    filled = DEFAULTS.get(table, {})
    return ", ".join(
        f"{f.name} {f.dataType.simpleString()}" + (f" DEFAULT {filled[f.name]}" if f.name in filled else "")
        for f in schema
    )


# Columns a later document of the same order overwrites; all others keep their first value.
UPDATED_COLUMNS = (
    "order_status",
    "carrier",
    "ship_date",
    "estimated_delivery",
    "delay_days",
    "inventory_level",
    "payment_status",
    "customer_name",
    "customer_region",
    "supplier_name",
    "performance_score",
    "warehouse_id",
    "warehouse_location",
    "transformed_at",
)
