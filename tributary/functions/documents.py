"""Typed fields of an order document."""

from typing import NamedTuple

from pyspark.sql import DataFrame

from tributary.functions.dates import is_day_first, order_timestamp
from tributary.functions.text import clean


class Field(NamedTuple):
    name: str
    path: str
    type: str = "string"


NUMBER = "decimal(38,0)"  # rounds half away from zero; a bigint cast would truncate
FLOAT = "double"

FIELDS = (
    Field("order_id", "$.order_id"),
    Field("order_date_text", "$.order_date"),
    Field("order_status", "$.order_status"),
    Field("customer_id", "$.customer.customer_id"),
    Field("customer_name", "$.customer.customer_name"),
    Field("customer_region", "$.customer.region"),
    Field("customer_segment", "$.customer.segment"),
    Field("supplier_id", "$.supplier.supplier_id"),
    Field("supplier_name", "$.supplier.supplier_name"),
    Field("supplier_country", "$.supplier.country"),
    Field("lead_time_days", "$.supplier.lead_time_days", NUMBER),
    Field("performance_score", "$.supplier.performance_score", FLOAT),
    Field("supplier_performance_score", "$.supplier.supplier_performance_score", FLOAT),
    Field("shipment_id", "$.shipment.shipment_id"),
    Field("carrier", "$.shipment.carrier"),
    Field("ship_date_text", "$.shipment.ship_date"),
    Field("estimated_delivery_text", "$.shipment.estimated_delivery"),
    Field("delay_days", "$.shipment.delay_days", NUMBER),
    Field("product_id", "$.items[0].product_id"),
    Field("product_name", "$.items[0].product_name"),
    Field("category", "$.items[0].category"),
    Field("quantity", "$.items[0].quantity", NUMBER),
    Field("unit_price", "$.items[0].unit_price", FLOAT),
    Field("total_amount", "$.financials.total_amount", FLOAT),
    Field("payment_status", "$.financials.payment_status"),
    Field("warehouse_id", "$.warehouse.warehouse_id"),
    Field("warehouse_location", "$.warehouse.warehouse_location"),
    Field("inventory_level", "$.warehouse.inventory_level", NUMBER),
)

NUMERIC = tuple(f for f in FIELDS if f.type != "string")


def typed_columns(document: str) -> list[str]:
    """One column per field; a numeric field also keeps its text as ``<name>_text``.

    A missing parent or another shape gives NULL. ``inventory_given`` tells an
    explicit JSON null (true) from an absent field (false).
    """
    columns = []
    for field in FIELDS:
        text = f"variant_get({document}, '{field.path}', 'string')"
        if field.type == "string":
            columns.append(f"{text} AS {field.name}")
        else:
            number = f"try_variant_get({document}, '{field.path}', '{field.type}')"
            columns += [f"{number} AS {field.name}", f"{text} AS {field.name}_text"]
    level = f"variant_get({document}, '$.warehouse.inventory_level', 'variant')"
    return [*columns, f"{level} IS NOT NULL AS inventory_given"]


def with_typed_fields(raw_orders: DataFrame) -> DataFrame:
    """Typed fields, then the order date and status in the form the rules test.

    Each is read once here; rules and projection refer to the columns.
    """
    typed = raw_orders.selectExpr("*", *typed_columns("raw_data"))
    others = [c for c in typed.columns if c != "order_status"]
    date = "order_date_text"
    return typed.selectExpr(
        *others,
        f"{clean('order_status')} AS order_status",
        f"{is_day_first(date)} AS day_first",
        f"{order_timestamp(date)} AS order_timestamp",
    )


def uncastable(field: Field) -> str:
    """The document holds something here, but it is not a number."""
    return f"({field.name}_text IS NOT NULL AND {field.name} IS NULL)"
