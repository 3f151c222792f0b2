"""Schemas of the raw tables. Every field is nullable: dirt is expected.

Timestamps carry no zone, so a file means the same in every session.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
}


def _struct(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields.items()])


RAW_ORDERS = _struct(
    order_id="long",
    order_date="timestamp",
    # A double in the file, because a missing id was written as a float.
    customer_id="double",
    product_id="long",
    quantity="int",
    unit_price="double",
    discount_pct="int",
    payment_method="string",
    status="string",
)

PRODUCTS = _struct(
    product_id="long",
    product_name="string",
    category="string",
    brand="string",
    cost_price="double",
    is_active="boolean",
    weight_kg="double",
)

CUSTOMERS = _struct(
    customer_id="int",
    customer_name="string",
    city="string",
    country="string",
    customer_segment="string",
    email="string",
    signup_date="date",
)

CORRUPT_RECORD = "_corrupt_record"


def with_corrupt_record(schema: T.StructType) -> T.StructType:
    """The schema plus the column that keeps the text of unreadable lines."""
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_RECORD, T.StringType(), True)])
