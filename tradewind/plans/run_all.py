"""The whole chain in order: ingest, check, model, publish, monitor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewind.functions.storage import materialize
from tradewind.operators import drift, forecast, metrics, pricing, quality, series, stock
from tradewind.sources import lake as lake_tables
from tradewind.sources.reports import publish_models, read_report, write_report


def run_all(spark: SparkSession, csv_dir: str, lake: str, reports: str, window: tuple[str, str]) -> DataFrame:
    """Run every step and return the quality report; a failed rule does not stop the run."""
    write_report(lake_tables.ingest(spark, csv_dir, lake), f"{reports}/ingest_audit")
    products, clients, promotions, sales, events = [
        lake_tables.read_lake(spark, lake, t) for t in ("products", "clients", "promotions", "sales", "events")]
    write_report(quality.quality_report(products, clients, promotions, sales, events, window), f"{reports}/quality")

    demand = materialize(series.daily_demand(sales, products), "demand")
    dense = materialize(series.densify(demand), "dense")
    write_report(forecast.published_forecast(demand), f"{reports}/forecast")
    trials = materialize(forecast.evaluation_forecasts(dense, promotions), "trials")
    write_report(series.model_comparison(trials), f"{reports}/forecast_comparison")

    states = materialize(pricing.price_states(sales, products), "states")
    write_report(pricing.price_advice(states), f"{reports}/price_advice")
    write_report(pricing.product_prices(states, products), f"{reports}/product_prices")

    write_report(metrics.kpi_summary(sales, products, events), f"{reports}/kpis")
    for name, report in (
            ("revenue_by_category", metrics.revenue_by_category(sales, products)),
            ("revenue_by_month", metrics.revenue_by_month(sales)),
            ("promo_impact", metrics.promo_impact_sales_flag(sales))):
        write_report(report, f"{reports}/{name}")
    publish_models(sales, products, f"{reports}/models")
    write_report(drift.drift_report(sales, products), f"{reports}/drift")
    published = read_report(spark, f"{reports}/forecast").where("kind = 'forecast'")
    write_report(stock.stock_cover(products, published), f"{reports}/stock_cover")
    return read_report(spark, f"{reports}/quality")
