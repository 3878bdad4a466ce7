"""Descriptive profiles of the catalogue, the clients, the sales and the events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.functions.numeric import half_even, percent, ratio, scalar
from tradewind.operators.metrics import on_promo

# Right-closed age bands.
AGE_BANDS = [(17, 25, "18-25"), (25, 35, "26-35"), (35, 45, "36-45"), (45, 55, "46-55"), (55, 75, "56-75")]


def catalogue_profile(products: DataFrame) -> DataFrame:
    price = F.col("list_price")
    return products.groupBy("category").agg(
        F.count(F.lit(1)).alias("products"),
        F.min(price).alias("min_price"),
        F.floor(ratio(F.sum(price), F.count(price))).alias("mean_price"),
        F.max(price).alias("max_price"),
    ).orderBy(F.desc("products"), "category")


def client_profile(clients: DataFrame) -> DataFrame:
    """Client counts by city, segment and channel, stacked."""
    dims = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value"))
                     for d in ("city", "segment", "channel")])
    return clients.select(F.inline(dims)).groupBy("dimension", "value") \
        .agg(F.count(F.lit(1)).alias("clients")).orderBy("dimension", F.desc("clients"), "value")


def client_summary(clients: DataFrame) -> DataFrame:
    return clients.agg(
        F.count(F.lit(1)).alias("clients"),
        F.min("signup_date").alias("first_signup"), F.max("signup_date").alias("last_signup"),
        F.min("age").alias("min_age"), F.max("age").alias("max_age"),
        half_even(ratio(F.sum("age"), F.count("age")), 1).alias("mean_age"),
    )


def age_bands(clients: DataFrame) -> DataFrame:
    age = F.col("age")
    band = reduce(
        lambda w, b: w.when((age > b[0]) & (age <= b[1]), F.lit(b[2])),
        AGE_BANDS, F.when(age.isNull(), F.lit(None)))
    return clients.select(band.alias("band")).where(F.col("band").isNotNull()) \
        .groupBy("band").agg(F.count(F.lit(1)).alias("clients")).orderBy("band")


def sales_profile(sales: DataFrame, products: DataFrame, clients: DataFrame) -> DataFrame:
    """Size, period, value and coverage of the sales."""
    # one row per (client, product): the distinct counts then run on far fewer rows
    pairs = sales.groupBy("client_id", "product_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(on_promo()).alias("n_promo"), F.sum("amount").alias("amount"),
        F.min("sale_date").alias("first"), F.max("sale_date").alias("last"))
    totals = pairs.agg(
        F.sum("n").alias("sales"), F.min("first").alias("first_day"), F.max("last").alias("last_day"),
        F.sum("amount").alias("revenue"), F.sum("n_promo").alias("promo_sales"),
        F.countDistinct("client_id").alias("buyers"), F.countDistinct("product_id").alias("products_sold"))
    return totals.select(
        "sales", "first_day", "last_day", "revenue",
        F.floor(ratio(F.col("revenue"), F.col("sales"))).alias("mean_basket"),
        half_even(percent(F.col("promo_sales"), F.col("sales")), 1).alias("promo_share_pct"),
        "buyers", scalar(clients, F.count(F.lit(1))).alias("clients"),
        "products_sold", scalar(products, F.count(F.lit(1))).alias("products"),
    )


def event_funnel(events: DataFrame) -> DataFrame:
    counts = events.groupBy("action").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(W.partitionBy(F.lit(0)))  # over one row per action
    return counts.withColumn("share_pct", half_even(percent(F.col("n"), total), 1)) \
        .orderBy(F.desc("n"), "action")


def event_profile(events: DataFrame, sales: DataFrame) -> DataFrame:
    """Period, reach and cart adds of the events next to the number of purchases."""
    pairs = events.groupBy("client_id", "product_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("action") == "add_to_cart").alias("carts"),
        F.min("ts").alias("first"), F.max("ts").alias("last"))
    return pairs.agg(
        F.sum("n").alias("events"),
        F.min("first").cast("date").alias("first_day"), F.max("last").cast("date").alias("last_day"),
        F.countDistinct("client_id").alias("active_clients"),
        F.countDistinct("product_id").alias("products_viewed"),
        F.sum("carts").alias("cart_adds"),
    ).withColumn("purchases", scalar(sales, F.count(F.lit(1))))


def catalogue_status(products: DataFrame, sales: DataFrame) -> DataFrame:
    """What the served models know: products, and clients with a purchase."""
    return products.agg(F.count(F.lit(1)).alias("products")) \
        .withColumn("known_clients", scalar(sales, F.countDistinct("client_id")))
