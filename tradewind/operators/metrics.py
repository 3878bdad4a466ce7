"""Revenue reports and key indicators.

Facts are summed per product, client or day before they meet a dimension: the
partial sums absorb hot keys on the map side and the join sees one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numeric import half_even, percent, ratio, scalar, whole
from tradewind.schema import NO_PROMOTION


def on_promo() -> Column:
    return F.col("promo_id") != NO_PROMOTION


def line_revenue() -> Column:
    return F.col("quantity") * F.col("unit_price")


def per_product(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_sales"),
        F.sum("quantity").alias("units"),
        F.sum("amount").alias("amount"),
        F.sum(line_revenue()).alias("revenue"),
    )


def revenue_by_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    sold = per_product(sales).join(products.select("product_id", "category"), "product_id")
    totals = sold.groupBy("category").agg(
        F.sum("n_sales").alias("n_sales"), F.sum("amount").alias("revenue"))
    return totals.withColumn("mean_basket", whole(ratio(F.col("revenue"), F.col("n_sales")))) \
        .orderBy(F.desc("revenue"), "category")


def revenue_by_category_asc(sales: DataFrame, products: DataFrame) -> DataFrame:
    sold = per_product(sales).join(products.select("product_id", "category"), "product_id")
    return sold.groupBy("category").agg(F.sum("revenue").alias("revenue")).orderBy("revenue", "category")


def top_products(sales: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    """Best sellers by name and category; products sharing both count together."""
    sold = per_product(sales).join(products.select("product_id", "name", "category"), "product_id")
    return sold.groupBy("name", "category").agg(F.sum("n_sales").alias("n_sales")) \
        .orderBy(F.desc("n_sales"), "name", "category").limit(n)


def promo_sale_share(sales: DataFrame) -> DataFrame:
    return sales.agg(F.round(percent(F.count_if(on_promo()), F.count(F.lit(1))), 1).alias("promo_share_pct"))


def units_per_product(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(F.sum("quantity").alias("units"))


def kpi_summary(sales: DataFrame, products: DataFrame, events: DataFrame) -> DataFrame:
    """One row of business indicators over the sales of known products; a zero denominator gives null."""
    sold = per_product(sales).join(products.select("product_id", "unit_cost"), "product_id")
    totals = sold.agg(
        F.sum("revenue").alias("revenue"),
        F.sum(F.col("revenue") - F.col("units") * F.col("unit_cost")).alias("margin"),
        F.sum("units").alias("units"),
    )
    # one distinct count to a query: two in one aggregate would copy every sale for each
    known = sales.join(products.select("product_id"), "product_id", "left_semi")
    clients = scalar(known.select("client_id").distinct(), F.count("client_id"))
    orders = scalar(known.select("sale_id").distinct(), F.count("sale_id"))
    views = scalar(events, F.count_if(F.col("action") == "view"))
    stock = scalar(products, F.sum("stock"))
    c = F.col
    return totals.select("*", clients.alias("clients"), orders.alias("orders"), views.alias("views"), stock.alias("stock")).select(
        "revenue", "margin", "clients", "orders", "units", "views", "stock",
        F.round(percent(c("margin"), c("revenue")), 6).alias("margin_pct"),
        F.round(ratio(c("revenue"), c("orders")), 2).alias("mean_basket"),
        F.round(percent(c("orders"), c("views")), 6).alias("conversion_pct"),
        F.round(ratio(c("units"), c("stock")), 6).alias("stock_turn"),
        F.round(ratio(c("margin"), c("clients")), 2).alias("margin_per_client"),
    )


def revenue_by_month(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.date_format("sale_date", "yyyy-MM").alias("month")) \
        .agg(F.sum(line_revenue()).alias("revenue")).orderBy("month")


def daily_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("sale_date").agg(
        F.sum(line_revenue()).alias("revenue"),
        F.sum(F.when(on_promo(), line_revenue())).alias("promo_revenue"),
        F.max(on_promo()).alias("promo_day"),
    )


def promo_impact_sales_flag(sales: DataFrame) -> DataFrame:
    """A day counts as promotional when at least one of its sales was."""
    flag = F.col("promo_day")
    days = daily_revenue(sales).agg(
        F.sum(F.when(flag, F.col("revenue"))).alias("rev_with"),
        F.count_if(flag).alias("days_with"),
        F.sum(F.when(~flag, F.col("revenue"))).alias("rev_without"),
        F.count_if(~flag).alias("days_without"),
        F.sum("promo_revenue").alias("promo_revenue"),
        F.sum("revenue").alias("revenue"),
    )
    with_promo = ratio(F.col("rev_with"), F.col("days_with"))
    without = ratio(F.col("rev_without"), F.col("days_without"))
    return days.select(
        F.round(with_promo, 2).alias("revenue_per_promo_day"),
        F.round(without, 2).alias("revenue_per_plain_day"),
        F.round(F.try_divide(with_promo, without), 6).alias("promo_ratio"),
        F.round(percent(F.col("promo_revenue"), F.col("revenue")), 6).alias("promo_revenue_share_pct"),
    )


def spend_per_client(sales: DataFrame) -> DataFrame:
    return sales.groupBy("client_id").agg(F.sum(line_revenue()).alias("spend"))


def revenue_by_city(sales: DataFrame, clients: DataFrame, coordinates: DataFrame) -> DataFrame:
    # per-client totals first: one row per buyer makes the distinct count a plain count
    buyers = spend_per_client(sales).join(clients.select("client_id", "city"), "client_id")
    cities = buyers.groupBy("city").agg(F.sum("spend").alias("revenue"), F.count(F.lit(1)).alias("clients"))
    return cities.join(coordinates, "city", "left").select("city", "revenue", "clients", "lat", "lon") \
        .orderBy(F.desc("revenue"), "city")


def segment_offers(sales: DataFrame, clients: DataFrame, rules: DataFrame) -> DataFrame:
    buyers = spend_per_client(sales).join(clients.select("client_id", "segment"), "client_id")
    stats = buyers.groupBy("segment").agg(
        F.count(F.lit(1)).alias("clients"), F.sum("spend").alias("spend"))
    return stats.join(rules, "segment").select(
        "segment", "clients",
        F.round(ratio(F.col("spend"), F.col("clients")), 2).alias("mean_spend"),
        "discount_pct", "aim",
    ).orderBy("discount_pct", "segment")


def scorecard(forecast_errors: DataFrame, pricing: DataFrame, reco: DataFrame) -> DataFrame:
    """One row per model: metric, baseline, ours and the gain.

    ``forecast_errors``: rows (series, mae_naive, mae_model, mae_model_promo) with a MEAN row;
    ``pricing``: change_pct and margin_gain_pct per category; ``reco``: recall per model.
    """
    mean = forecast_errors.where(F.col("category") == "MEAN")
    kept = 1 - F.try_divide(F.col("mae_model_promo"), F.col("mae_naive"))
    demand = mean.select(
        F.lit("demand forecast").alias("model"), F.lit("mean absolute error").alias("metric"),
        F.col("mae_naive").alias("baseline"), F.col("mae_model_promo").alias("ours"),
        half_even(kept * F.lit(100.0).cast("double"), 0).alias("gain_value"),
        F.lit("error reduction %").alias("gain_kind"))
    price = pricing.agg(
        F.lit("price optimisation").alias("model"), F.lit("mean price change %").alias("metric"),
        F.lit(0.0).cast("double").alias("baseline"), half_even(F.avg("change_pct"), 1).alias("ours"),
        half_even(F.avg("margin_gain_pct"), 1).alias("gain_value"), F.lit("margin gain %").alias("gain_kind"))
    recall = F.max(F.when(F.col("model") == "collaborative", F.col("recall_pct")))
    chance = F.max(F.when(F.col("model") == "random", F.col("recall_pct")))
    lift = reco.agg(
        F.lit("recommendation").alias("model"), F.lit("recall %").alias("metric"),
        chance.alias("baseline"), recall.alias("ours"),
        half_even(F.try_divide(recall, chance), 0).alias("gain_value"), F.lit("times random").alias("gain_kind"))
    return demand.unionByName(price).unionByName(lift)
