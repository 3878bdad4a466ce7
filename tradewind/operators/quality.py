"""The data-quality rule set: each rule counts its anomalies, zero means PASS."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.schema import ACTIONS


def orphan_rows(facts: DataFrame, key: str, dimension: DataFrame) -> DataFrame:
    """Fact rows whose key is null or unknown to the dimension."""
    return facts.join(dimension.select(key).distinct(), key, "left_anti")


def _orphans_per_key(facts: DataFrame, key: str, dimension: DataFrame) -> DataFrame:
    # one row per key value before the anti join, so a hot key costs one row
    counted = facts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(dimension.select(key).distinct(), key, "left_anti")


def orphan_keys(sales: DataFrame, events: DataFrame, clients: DataFrame,
                products: DataFrame, promotions: DataFrame) -> DataFrame:
    checks = [
        ("sales.client_id in clients", sales, "client_id", clients),
        ("sales.product_id in products", sales, "product_id", products),
        ("sales.promo_id in promotions", sales, "promo_id", promotions),
        ("events.client_id in clients", events, "client_id", clients),
        ("events.product_id in products", events, "product_id", products),
    ]
    return reduce(DataFrame.unionByName, [
        _orphans_per_key(facts, key, dim).agg(
            F.lit("foreign keys").alias("family"), F.lit(rule).alias("rule"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("anomalies"))
        for rule, facts, key, dim in checks
    ])


def _repeats(df: DataFrame, key: str, rule: str) -> DataFrame:
    """Rows beyond the number of distinct keys; null keys count, as do their rows."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit("unique keys").alias("family"), F.lit(rule).alias("rule"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(key)).cast("bigint").alias("anomalies"))


def _rules(df: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """All single-pass rules of one table in one aggregate, then one row per rule."""
    counts = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)])
    stacked = F.array(*[
        F.struct(F.lit(family).alias("family"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("anomalies"))
        for i, (family, rule, _) in enumerate(rules)])
    return counts.select(F.inline(stacked))


def quality_report(products: DataFrame, clients: DataFrame, promotions: DataFrame,
                   sales: DataFrame, events: DataFrame, window: tuple[str, str]) -> DataFrame:
    c = F.col
    first, last = [F.lit(d).cast("date") for d in window]
    client_rules = _rules(clients, [
        ("keys present", "clients.client_id", c("client_id").isNull()),
        ("values", "age 18 to 75", (c("age") < 18) | (c("age") > 75)),
    ])
    sale_rules = _rules(sales, [
        ("keys present", "sales.sale_id", c("sale_id").isNull()),
        ("values", "quantity > 0", c("quantity") <= 0),
        ("values", "unit_price > 0", c("unit_price") <= 0),
        ("values", "amount = unit_price * quantity", c("amount") != c("unit_price") * c("quantity")),
        ("dates", "sale inside the window", (c("sale_date") < first) | (c("sale_date") > last)),
    ])
    # the highest price paid per product and the day sales per client, so that the joins
    # with the dimensions see one row per key value instead of every sale
    over_list = sales.groupBy("product_id", "unit_price").agg(F.count(F.lit(1)).alias("n")) \
        .join(products.select("product_id", "list_price"), "product_id") \
        .where(c("unit_price") > c("list_price"))
    before_signup = sales.groupBy("client_id", "sale_date").agg(F.count(F.lit(1)).alias("n")) \
        .join(clients.select("client_id", "signup_date"), "client_id") \
        .where(c("sale_date") < c("signup_date"))

    def counted(df: DataFrame, family: str, rule: str) -> DataFrame:
        return df.agg(F.lit(family).alias("family"), F.lit(rule).alias("rule"),
                      F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("anomalies"))

    event_rules = _rules(events, [
        ("values", "known action", ~c("action").isin(ACTIONS)),
    ])
    funnel = events.agg(F.count_if(c("action") == "add_to_cart").alias("carts")).select(
        F.lit("funnel").alias("family"), F.lit("more cart adds than sales").alias("rule"),
        F.when(c("carts") > sales.agg(F.count(F.lit(1)).alias("n")).scalar(), F.lit(0)).otherwise(F.lit(1))
        .cast("bigint").alias("anomalies"))
    parts = [
        _repeats(products, "product_id", "products.product_id"),
        _repeats(clients, "client_id", "clients.client_id"),
        _repeats(sales, "sale_id", "sales.sale_id"),
        _repeats(events, "event_id", "events.event_id"),
        client_rules, sale_rules,
        orphan_keys(sales, events, clients, products, promotions),
        counted(over_list, "values", "unit_price <= list_price"),
        _rules(promotions, [("values", "rate 0 to 1", (c("rate") < 0) | (c("rate") > 1))]),
        event_rules,
        counted(before_signup, "dates", "no sale before signup"),
        funnel,
    ]
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("status", F.when(c("anomalies") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")))


def quality_totals(report: DataFrame) -> DataFrame:
    passed = F.count_if(F.col("status") == "PASS")
    return report.agg(passed.alias("passed"), F.count(F.lit(1)).alias("rules"),
                      (passed == F.count(F.lit(1))).alias("all_valid"))
