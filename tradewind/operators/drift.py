"""Drift between a reference period and the recent months (population stability index)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numeric import dbl, half_even, ratio, scalar
from tradewind.functions.running import exact_quantiles
from tradewind.functions.storage import materialize

BINS = 10
FLOOR = 1e-4
MODERATE, IMPORTANT = 0.10, 0.25
RECENT_MONTHS = 3


def split_recent(sales: DataFrame, months: int = RECENT_MONTHS) -> DataFrame:
    """Add ``recent``: true from ``max(sale_date) - months`` on."""
    cut = F.add_months(scalar(sales, F.max("sale_date")), -months)
    return sales.withColumn("recent", F.col("sale_date") >= cut)


def period_bounds(sales: DataFrame, months: int = RECENT_MONTHS) -> DataFrame:
    return split_recent(sales, months).groupBy("recent").agg(
        F.min("sale_date").alias("first_day"), F.max("sale_date").alias("last_day"),
        F.count(F.lit(1)).alias("sales"))


def _floored(share: Column) -> Column:
    return F.greatest(F.coalesce(share, dbl(0)), dbl(FLOOR))


def numeric_psi(values: DataFrame, value: str, bins: int = BINS) -> DataFrame:
    """PSI of ``value`` with quantile bins of the reference rows, as one row.

    ``values``: rows (value, recent, n), ``n`` being how often the value occurs.
    """
    inner = [i / bins for i in range(1, bins)]
    edges = exact_quantiles(values.where(~F.col("recent")), value, inner, weight="n")
    edge_list = edges.agg(F.collect_list("edge").alias("e")).scalar()  # bins - 1 numbers
    bin_no = F.size(F.filter(F.col("edges"), lambda e: e <= F.col(value)))
    binned = values.withColumn("edges", edge_list).groupBy(bin_no.alias("bin_no")).agg(
        F.sum(F.when(~F.col("recent"), F.col("n"))).alias("ref_n"),
        F.sum(F.when(F.col("recent"), F.col("n"))).alias("rec_n"))
    sides = values.groupBy("recent").agg(F.sum("n").alias("n"))
    ref_all = scalar(sides, F.sum(F.when(~F.col("recent"), F.col("n"))))
    rec_all = scalar(sides, F.sum(F.when(F.col("recent"), F.col("n"))))
    every_bin = values.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin_no"))
    shares = every_bin.join(binned, "bin_no", "left").select(
        _floored(ratio(F.col("ref_n"), ref_all)).alias("a"), _floored(ratio(F.col("rec_n"), rec_all)).alias("b"))
    return shares.agg(F.sum((F.col("b") - F.col("a")) * F.ln(F.col("b") / F.col("a"))).alias("psi"))


def _mix_terms(facts: DataFrame, products: DataFrame, months: int = RECENT_MONTHS) -> DataFrame:
    n = F.col("n")
    per = split_recent(facts, months).groupBy("product_id").agg(
        F.sum(F.when(F.col("recent"), 0).otherwise(n)).alias("ref_n"),
        F.sum(F.when(F.col("recent"), n).otherwise(0)).alias("rec_n"))
    cats = per.join(products.select("product_id", "category"), "product_id") \
        .groupBy("category").agg(F.sum("ref_n").alias("ref_n"), F.sum("rec_n").alias("rec_n"))
    ref_all, rec_all = scalar(cats, F.sum("ref_n")), scalar(cats, F.sum("rec_n"))
    a, b = F.col("ref_share"), F.col("recent_share")
    return cats.where(F.col("ref_n") > 0).select(
        "category", ratio(F.col("ref_n"), ref_all).alias("ref_share"),
        F.coalesce(ratio(F.col("rec_n"), rec_all), dbl(0)).alias("recent_share")) \
        .withColumn("psi_term", (b - a) * F.ln(_floored(b) / _floored(a)))


def category_mix(sales: DataFrame, products: DataFrame, months: int = RECENT_MONTHS) -> DataFrame:
    """Share of sales per category in both periods and its PSI term.

    The difference is not floored, the logarithm is; categories unknown to the
    reference period drop out.
    """
    facts = sales.groupBy("product_id", "sale_date").agg(F.count(F.lit(1)).alias("n"))
    return _mix_terms(materialize(facts, "mix"), products, months)


def mix_drift(sales: DataFrame, products: DataFrame) -> DataFrame:
    return category_mix(sales, products).select(
        "category", *[F.round(c, 6).alias(c) for c in ("ref_share", "recent_share", "psi_term")])


def verdict(psi: Column) -> Column:
    return F.when(psi < MODERATE, "stable").when(psi < IMPORTANT, "moderate drift").otherwise("important drift")


def drift_report(sales: DataFrame, products: DataFrame) -> DataFrame:
    """One row per indicator: PSI at three decimals, means before and after, verdict."""
    # one pass over the sales; every indicator then reads this much smaller table
    summed = sales.groupBy("product_id", "unit_price", "sale_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("units"))
    facts = materialize(summed.join(products.select("product_id"), "product_id"), "drift")
    flagged = split_recent(facts)
    demand = materialize(flagged.groupBy("sale_date", "recent").agg(F.sum("units").alias("units"))
                         .select("units", "recent", F.lit(1).alias("n")), "drift-demand")
    prices = materialize(flagged.groupBy("unit_price", "recent").agg(F.sum("n").alias("n")), "drift-prices")

    def indicator(name: str, psi: DataFrame) -> DataFrame:
        return psi.select(F.lit(name).alias("indicator"), half_even(F.col("psi"), 3).alias("psi"))

    def with_means(row: DataFrame, values: DataFrame, value: str) -> DataFrame:
        weighted = F.col(value) * F.col("n")
        mean = lambda side: half_even(ratio(
            F.sum(F.when(side, weighted)), F.sum(F.when(side, F.col("n")))))
        means = values.agg(F.struct(
            mean(~F.col("recent")).alias("ref"), mean(F.col("recent")).alias("rec")).alias("m")).scalar()
        return row.withColumn("m", means).select(
            "indicator", "psi", F.col("m.ref").alias("mean_ref"), F.col("m.rec").alias("mean_recent"))

    mix = _mix_terms(facts, products).agg(F.sum("psi_term").alias("psi"))
    none = F.lit(None).cast("double")
    report = with_means(indicator("daily_demand", numeric_psi(demand, "units")), demand, "units") \
        .unionByName(with_means(indicator("unit_price", numeric_psi(prices, "unit_price")), prices, "unit_price")) \
        .unionByName(indicator("category_mix", mix).select(
            "*", none.alias("mean_ref"), none.alias("mean_recent")))
    return report.withColumn("verdict", verdict(F.col("psi")))


def drift_alert(report: DataFrame) -> DataFrame:
    """Overall state; the bounds are strict here, unlike in the row verdicts."""
    worst = F.max("psi")
    return report.agg(F.when(worst > IMPORTANT, "retrain").when(worst > MODERATE, "watch")
                      .otherwise("valid").alias("alert"))
