"""Tables of the retail star schema: types, keys and fixed vocabularies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)


@dataclass(frozen=True)
class Table:
    name: str
    schema: StructType
    key: str


def _table(table: str, key: str, /, **columns) -> Table:
    fields = [StructField(c, t(), c != key) for c, t in columns.items()]
    return Table(table, StructType(fields), key)


PRODUCTS = _table(
    "products", "product_id",
    product_id=LongType, name=StringType, category=StringType, brand=StringType,
    list_price=LongType, unit_cost=LongType, stock=IntegerType,
)
CLIENTS = _table(
    "clients", "client_id",
    client_id=LongType, name=StringType, age=IntegerType, city=StringType,
    signup_date=DateType, segment=StringType, channel=StringType,
)
PROMOTIONS = _table(
    "promotions", "promo_id",
    promo_id=IntegerType, campaign=StringType, kind=StringType, rate=DoubleType,
    start_date=DateType, end_date=DateType,
)
SALES = _table(
    "sales", "sale_id",
    sale_id=LongType, client_id=LongType, product_id=LongType, promo_id=IntegerType,
    sale_date=DateType, quantity=IntegerType, unit_price=LongType, amount=LongType,
)
EVENTS = _table(
    "events", "event_id",
    event_id=LongType, client_id=LongType, product_id=LongType,
    ts=TimestampType, action=StringType,
)

TABLES = {t.name: t for t in (PRODUCTS, CLIENTS, PROMOTIONS, SALES, EVENTS)}

# One sale as it travels on the stream: flat, the date as text.
SALE_EVENT = StructType([
    StructField("sale_id", StringType()),
    StructField("client_id", LongType()),
    StructField("product", StringType()),
    StructField("category", StringType()),
    StructField("sale_date", StringType()),
    StructField("quantity", IntegerType()),
    StructField("amount", LongType()),
])

# Fixed values.
NO_PROMOTION = 0
ACTIONS = ["view", "click", "add_to_cart"]
UNKNOWN = "?"
