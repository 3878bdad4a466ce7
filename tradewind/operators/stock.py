"""Days of stock cover per category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numeric import dbl, half_even, ratio, scalar

SHORTAGE_DAYS, HEALTHY_DAYS = 30, 90


def cover_status(days: Column) -> Column:
    """Below 30 shortage, to 90 healthy, above overstock; no demand lasts for ever."""
    return F.when(days < SHORTAGE_DAYS, "shortage risk").when(days <= HEALTHY_DAYS, "healthy") \
        .otherwise("overstock")


def stock_cover(products: DataFrame, forecast: DataFrame) -> DataFrame:
    """Stock of a category over its forecast demand per day.

    ``forecast``: future rows (category, ds, yhat); negative category totals count as 0.
    """
    horizon = scalar(forecast, F.countDistinct("ds"))
    demand = forecast.groupBy("category").agg(F.greatest(F.sum("yhat"), dbl(0)).alias("demand"))
    stock = products.groupBy("category").agg(F.sum("stock").alias("stock"))
    # a category without any forecast row has unknown demand: cover stays null, as with zero demand
    per_day = F.try_divide(F.col("demand"), F.col("horizon").cast("double"))
    return stock.join(demand, "category", "left").withColumn("horizon", horizon).select(
        "category", "stock", F.round("demand", 4).alias("demand"),
        half_even(ratio(F.col("stock"), per_day)).alias("cover_days")) \
        .withColumn("status", cover_status(F.col("cover_days"))).orderBy("cover_days", "category")
