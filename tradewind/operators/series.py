"""Regular daily series, promotion calendar, smoothing, naive forecasts and their errors.

After the daily aggregation a series holds one row per calendar day, so windows
by series stay short whatever the number of sales.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.functions.numeric import dbl, half_even, ratio, scalar
from tradewind.operators.metrics import daily_revenue, line_revenue
from tradewind.schema import NO_PROMOTION

TEST_DAYS = 30
SEASON_DAYS = 7


def daily_demand(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Units per category and sale day; days without a sale are absent."""
    per_day = sales.groupBy("product_id", "sale_date").agg(F.sum("quantity").alias("units"))
    return per_day.join(products.select("product_id", "category"), "product_id") \
        .groupBy("category", F.col("sale_date").alias("ds")).agg(F.sum("units").alias("units"))


def _day_range(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last))


def densify(demand: DataFrame, series: str = "category", value: str = "units") -> DataFrame:
    """Every series on every day between the global first and last day, zeros filled in."""
    first, last = scalar(demand, F.min("ds")), scalar(demand, F.max("ds"))
    grid = demand.select(series).distinct().select(series, _day_range(first, last).alias("ds"))
    return grid.join(demand, [series, "ds"], "left") \
        .select(series, "ds", F.coalesce(F.col(value), F.lit(0)).cast("bigint").alias(value))


def demand_totals(demand: DataFrame) -> DataFrame:
    return demand.groupBy("category").agg(F.sum("units").alias("units")).orderBy(F.desc("units"), "category")


def demand_by_weekday(dense: DataFrame) -> DataFrame:
    """Mean total demand per weekday, Monday = 0."""
    days = dense.groupBy("ds").agg(F.sum("units").alias("units"))
    return days.groupBy(F.weekday("ds").alias("weekday")).agg(
        F.round(ratio(F.sum("units"), F.count(F.lit(1))), 6).alias("mean_units")).orderBy("weekday")


def monthly_units_revenue(sales: DataFrame) -> DataFrame:
    """Units, revenue and sale count per calendar month; empty months give zeros."""
    days = sales.groupBy("sale_date").agg(
        F.sum("quantity").alias("units"), F.sum(line_revenue()).alias("revenue"), F.count(F.lit(1)).alias("n_sales"))
    months = days.groupBy(F.trunc("sale_date", "month").alias("month")).agg(
        F.sum("units").alias("units"), F.sum("revenue").alias("revenue"), F.sum("n_sales").alias("n_sales"))
    span = months.agg(F.min("month").alias("a"), F.max("month").alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("units", "revenue", "n_sales")]
    return span.join(months, "month", "left").select("month", *zero).orderBy("month")


def _trailing(series: str | None, rows: int) -> "W":
    base = W.partitionBy(series) if series else W.partitionBy(F.lit(0))
    return base.orderBy("ds").rowsBetween(1 - rows, 0)


def rolling_mean(df: DataFrame, value: str, series: str | None = None, rows: int = 7) -> DataFrame:
    """Trailing mean over ``rows`` rows, shorter at the start of a series."""
    w = _trailing(series, rows)
    mean = ratio(F.sum(value).over(w), F.count(value).over(w))
    return df.withColumn(f"{value}_mean{rows}", F.round(mean, 6))


def rolling_demand(dense: DataFrame, rows: int = 7) -> DataFrame:
    return rolling_mean(dense, "units", "category", rows)


def rolling_revenue(sales: DataFrame, rows: int = 7) -> DataFrame:
    """Smoothed daily revenue over sale days only: rows, not calendar days."""
    days = daily_revenue(sales).select(F.col("sale_date").alias("ds"), "revenue")
    return rolling_mean(days, "revenue", None, rows).withColumn("revenue_mean7", F.round("revenue_mean7", 2))


def campaign_days(promotions: DataFrame) -> DataFrame:
    """Highest active rate per campaign day (the interval join as rows)."""
    dated = promotions.where((F.col("promo_id") != NO_PROMOTION) & (F.col("start_date") <= F.col("end_date")))
    return dated.select("rate", _day_range(F.col("start_date"), F.col("end_date")).alias("ds")) \
        .groupBy("ds").agg(F.max("rate").alias("promo_rate"))


def promo_calendar(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Every day of the sales period with its promotion rate, 0 where none runs."""
    days = sales.agg(F.min("sale_date").alias("a"), F.max("sale_date").alias("b")) \
        .select(_day_range(F.col("a"), F.col("b")).alias("ds"))
    return with_promo_rate(days, promotions)


def with_promo_rate(df: DataFrame, promotions: DataFrame) -> DataFrame:
    return df.join(campaign_days(promotions), "ds", "left") \
        .withColumn("promo_rate", F.greatest(F.coalesce("promo_rate", dbl(0)), dbl(0)))


def promo_lift_calendar(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Mean revenue of sale days inside and outside any campaign, and the lift."""
    days = daily_revenue(sales).select(F.col("sale_date").alias("ds"), "revenue")
    inside = campaign_days(promotions).select("ds", F.lit(True).alias("inside"))
    flagged = days.join(inside, "ds", "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    flag = F.col("inside")
    sums = flagged.agg(
        F.sum(F.when(flag, F.col("revenue"))).alias("r1"), F.count_if(flag).alias("n1"),
        F.sum(F.when(~flag, F.col("revenue"))).alias("r0"), F.count_if(~flag).alias("n0"))
    on, off = ratio(F.col("r1"), F.col("n1")), ratio(F.col("r0"), F.col("n0"))
    return sums.select(
        F.round(on, 2).alias("revenue_per_campaign_day"), F.round(off, 2).alias("revenue_per_other_day"),
        F.round((F.try_divide(on, off) - 1) * dbl(100), 6).alias("lift_pct"))


def split_last_days(dense: DataFrame, test_days: int = TEST_DAYS, series: str = "category") -> DataFrame:
    """Mark the last rows of every series as the test part."""
    rank = F.row_number().over(W.partitionBy(series).orderBy(F.desc("ds")))
    return dense.withColumn("is_test", rank <= test_days)


def naive_forecast(dense: DataFrame, test_days: int = TEST_DAYS) -> DataFrame:
    """Seasonal naive: the value seven rows earlier, actuals of the test part included."""
    w = W.partitionBy("category").orderBy("ds")
    lagged = dense.withColumn("yhat", F.lag("units", SEASON_DAYS).over(w).cast("double"))
    return split_last_days(lagged, test_days).where("is_test") \
        .select("category", "ds", F.col("units").alias("y"), "yhat")


def training_tail(dense: DataFrame, rows: int = 60, test_days: int = TEST_DAYS) -> DataFrame:
    """The last training rows before the test part, as shown next to a forecast."""
    rank = F.row_number().over(W.partitionBy("category").orderBy(F.desc("ds")))
    return dense.withColumn("age", rank).where(F.col("age").between(test_days + 1, test_days + rows)) \
        .select("category", "ds", "units")


def forecast_errors(forecast: DataFrame, *by: str) -> DataFrame:
    """MAE, RMSE and MAPE per group; zero actuals leave the MAPE, none left gives null."""
    err = F.abs(F.col("y") - F.col("yhat"))
    share = F.when(F.col("y") != 0, err / F.abs(F.col("y")))
    return forecast.groupBy(*by).agg(
        F.avg(err).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"), (F.avg(share) * dbl(100)).alias("mape"))


def backtest_table(forecast: DataFrame, digits: int = 6) -> DataFrame:
    """Errors per category, and a MEAN row over the unrounded category errors."""
    errors = forecast_errors(forecast, "category")
    mean = errors.agg(F.lit("MEAN").alias("category"), *[F.avg(m).alias(m) for m in ("mae", "rmse", "mape")])
    both = errors.unionByName(mean)
    return both.select("category", *[F.round(m, digits).alias(m) for m in ("mae", "rmse", "mape")])


def model_comparison(forecasts: DataFrame) -> DataFrame:
    """One row per category with the MAE of each model at one decimal, and a MEAN row of those.

    ``forecasts`` stacks (model, category, ds, y, yhat) for naive, model and model_promo.
    """
    models = ["naive", "model", "model_promo"]
    per = forecast_errors(forecasts, "category", "model")
    wide = per.groupBy("category").agg(*[
        half_even(F.max(F.when(F.col("model") == m, F.col("mae"))), 1).alias(f"mae_{m}") for m in models])
    mean = wide.agg(F.lit("MEAN").alias("category"),
                    *[half_even(F.avg(f"mae_{m}"), 1).alias(f"mae_{m}") for m in models])
    return wide.unionByName(mean)


def experiment_table(forecasts: DataFrame, horizon: int = TEST_DAYS) -> DataFrame:
    """Mean errors over categories per model, rounded only at the end."""
    per = forecast_errors(forecasts, "model", "category")
    return per.groupBy("model").agg(
        F.lit(horizon).alias("horizon_days"), F.count(F.lit(1)).alias("series"),
        *[half_even(F.avg(m), 2).alias(m) for m in ("mae", "rmse", "mape")])
