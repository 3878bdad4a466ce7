"""Named queries over the star schema: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.running import with_running_sums
from tradewind.functions.storage import fresh_path, materialize
from tradewind.operators import (
    cleaning, drift, forecast, history, metrics, preview, pricing, profile, quality, recommend, series, similarity, stock,
)
from tradewind.functions.text import grouped_digits, indicator_label, month_label
from tradewind.schema import PRODUCTS
from tradewind.sources import lake, reports
from tradewind.sources.star import SALES_WINDOW, Star
from tradewind.streaming import sales_stream

K = 5
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """Register a builder under its own name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Star(spark, sf_dir))
    return build


def _stored_sales(s: Star, *columns: str) -> DataFrame:
    """Sales written once in narrow form, for queries that read them several times."""
    return materialize(s.sales.select(*columns) if columns else s.sales, "sales")


def _with_unknown(ids: DataFrame) -> DataFrame:
    """Request list: every known id and one nobody knows."""
    return ids.unionByName(ids.sparkSession.range(1).select(F.lit(-1).alias(ids.columns[0])))


# --- ingest ---------------------------------------------------------------------------

@query
def clean_sales(s: Star) -> DataFrame:
    return cleaning.one_row_per_key(s.raw_sales, "sale_id")


@query
def ingest_audit(s: Star) -> DataFrame:
    return cleaning.key_audit({
        "products": (s.products, "product_id"), "clients": (s.clients, "client_id"),
        "promotions": (s.promotions, "promo_id"), "sales": (s.raw_sales, "sale_id"),
        "events": (s.events, "event_id")})


def _messy_products(s: Star) -> str:
    """The products as CSV, with a price that is no number in one line of ten and every seventh line twice."""
    folder = fresh_path(s.spark, "raw-products")
    price = F.when(F.col("product_id") % 10 == 3, F.concat(F.lit("?"), F.col("list_price"))).otherwise(F.col("list_price").cast("string"))
    rows = s.products.withColumn("list_price", price)
    rows.unionByName(rows.where("product_id % 7 = 0")).write.option("header", True).csv(folder)
    return folder


@query
def csv_audit(s: Star) -> DataFrame:
    return lake.ingest_checked(s.spark, _messy_products(s), fresh_path(s.spark, "lake"), PRODUCTS)


@query
def csv_products(s: Star) -> DataFrame:
    """What the lake holds of them."""
    folder = fresh_path(s.spark, "lake")
    lake.ingest_checked(s.spark, _messy_products(s), folder, PRODUCTS)
    return lake.read_lake(s.spark, folder, "products")


@query
def csv_quarantine(s: Star) -> DataFrame:
    """The lines put aside."""
    folder = fresh_path(s.spark, "lake")
    lake.ingest_checked(s.spark, _messy_products(s), folder, PRODUCTS)
    return lake.read_lake(s.spark, f"{folder}/quarantine", "products")


@query
def quality_report(s: Star) -> DataFrame:
    return quality.quality_report(
        s.products, s.clients, s.promotions, _stored_sales(s), s.events, SALES_WINDOW)


@query
def quality_totals(s: Star) -> DataFrame:
    return quality.quality_totals(quality_report(s))


@query
def orphan_keys(s: Star) -> DataFrame:
    return quality.orphan_keys(s.sales, s.events, s.clients, s.products, s.promotions)


@query
def revenue_of_two_years(s: Star) -> DataFrame:
    """Revenue per month of 1998 and 1999, from a lake with a folder per month."""
    folder = fresh_path(s.spark, "lake")
    lake.write_sales_by_month(s.sales, folder)
    return metrics.revenue_by_month(lake.read_sales_between(s.spark, folder, "1998-01-01", "1999-12-31"))


@query
def sales_preview(s: Star) -> DataFrame:
    """The first sales in time."""
    return preview.first_rows(s.sales, 20, "sale_date", "sale_id")


@query
def sales_sample(s: Star) -> DataFrame:
    """Twenty sales, the same on every run."""
    return preview.seeded_sample(s.sales, 20, "sale_id")


@query
def product_sample(s: Star) -> DataFrame:
    return preview.seeded_sample(s.products, 5, "product_id", seed=7)


# --- revenue and key indicators -----------------------------------------------------------

@query
def revenue_by_category(s: Star) -> DataFrame:
    return metrics.revenue_by_category(s.sales, s.products)


@query
def revenue_by_category_asc(s: Star) -> DataFrame:
    return metrics.revenue_by_category_asc(s.sales, s.products)


@query
def top_products(s: Star) -> DataFrame:
    return metrics.top_products(s.sales, s.products)


@query
def units_per_product(s: Star) -> DataFrame:
    return metrics.units_per_product(s.sales)


@query
def promo_sale_share(s: Star) -> DataFrame:
    return metrics.promo_sale_share(s.sales)


@query
def kpi_summary(s: Star) -> DataFrame:
    return metrics.kpi_summary(s.sales, s.products, s.events)


@query
def revenue_by_month(s: Star) -> DataFrame:
    return metrics.revenue_by_month(s.sales)


@query
def revenue_by_month_labelled(s: Star) -> DataFrame:
    return metrics.revenue_by_month(s.sales).select(
        "month", month_label(F.col("month")).alias("label"), "revenue", grouped_digits(F.col("revenue")).alias("shown"))


@query
def promo_impact_sales_flag(s: Star) -> DataFrame:
    return metrics.promo_impact_sales_flag(s.sales)


@query
def promo_lift_calendar(s: Star) -> DataFrame:
    return series.promo_lift_calendar(s.sales, s.promotions)


@query
def revenue_by_city(s: Star) -> DataFrame:
    return metrics.revenue_by_city(s.sales, s.clients, s.city_coordinates)


@query
def segment_offers(s: Star) -> DataFrame:
    return metrics.segment_offers(s.sales, s.clients, s.segment_rules)


# --- profiles -------------------------------------------------------------------------------

@query
def catalogue_profile(s: Star) -> DataFrame:
    return profile.catalogue_profile(s.products)


@query
def client_profile(s: Star) -> DataFrame:
    return profile.client_profile(s.clients)


@query
def client_summary(s: Star) -> DataFrame:
    return profile.client_summary(s.clients)


@query
def age_bands(s: Star) -> DataFrame:
    return profile.age_bands(s.clients)


@query
def sales_profile(s: Star) -> DataFrame:
    return profile.sales_profile(s.sales, s.products, s.clients)


@query
def event_funnel(s: Star) -> DataFrame:
    return profile.event_funnel(s.events)


@query
def event_profile(s: Star) -> DataFrame:
    return profile.event_profile(s.events, s.sales)


@query
def catalogue_status(s: Star) -> DataFrame:
    return profile.catalogue_status(s.products, s.sales)


# --- series -----------------------------------------------------------------------------------

@query
def daily_demand(s: Star) -> DataFrame:
    return series.daily_demand(s.sales, s.products)


@query
def daily_demand_dense(s: Star) -> DataFrame:
    return series.densify(materialize(daily_demand(s), "demand"))


@query
def demand_totals(s: Star) -> DataFrame:
    return series.demand_totals(daily_demand(s))


@query
def demand_by_weekday(s: Star) -> DataFrame:
    return series.demand_by_weekday(daily_demand_dense(s))


@query
def monthly_units_revenue(s: Star) -> DataFrame:
    return series.monthly_units_revenue(s.sales)


@query
def demand_rolling7(s: Star) -> DataFrame:
    return series.rolling_demand(daily_demand_dense(s))


@query
def revenue_rolling7(s: Star) -> DataFrame:
    return series.rolling_revenue(s.sales)


@query
def promo_calendar(s: Star) -> DataFrame:
    return series.promo_calendar(s.sales, s.promotions)


@query
def naive_forecast(s: Star) -> DataFrame:
    return series.naive_forecast(daily_demand_dense(s))


@query
def naive_backtest(s: Star) -> DataFrame:
    return series.backtest_table(naive_forecast(s))


@query
def training_tail(s: Star) -> DataFrame:
    return series.training_tail(daily_demand_dense(s))


# --- pricing ------------------------------------------------------------------------------------

def _states(s: Star) -> DataFrame:
    return pricing.price_states(s.sales, s.products)


def _sold(s: Star) -> DataFrame:
    return pricing.sold_prices(product_prices(s), s.sales)


@query
def price_states(s: Star) -> DataFrame:
    return _states(s).select("category", "on_promo", "units", "n_days", *[
        F.round(c, 6).alias(c) for c in ("price", "cost", "units_per_day")])


@query
def elasticity_by_category(s: Star) -> DataFrame:
    return pricing.elasticity_table(_states(s))


@query
def optimal_price_by_category(s: Star) -> DataFrame:
    return pricing.price_advice(_states(s), round_inputs=True)


@query
def margin_curve(s: Star) -> DataFrame:
    return pricing.margin_curve(_states(s))


@query
def product_prices(s: Star) -> DataFrame:
    return pricing.product_prices(_states(s), s.products)


@query
def price_lookup(s: Star) -> DataFrame:
    return pricing.price_lookup(product_prices(s), _with_unknown(s.products.select("product_id")))


@query
def price_opportunities(s: Star) -> DataFrame:
    return pricing.price_opportunities(materialize(_sold(s), "sold"))


@query
def repricing_potential(s: Star) -> DataFrame:
    return pricing.repricing_potential(_sold(s))


@query
def price_what_if(s: Star) -> DataFrame:
    return pricing.price_what_if(_sold(s))


@query
def pricing_summary(s: Star) -> DataFrame:
    return pricing.pricing_summary(materialize(_states(s), "states"))


# --- drift and stock -------------------------------------------------------------------------------

@query
def drift_periods(s: Star) -> DataFrame:
    return drift.period_bounds(s.sales)


@query
def drift_report(s: Star) -> DataFrame:
    return drift.drift_report(s.sales, s.products)


@query
def drift_report_labelled(s: Star) -> DataFrame:
    return drift_report(s).select(indicator_label(F.col("indicator")).alias("label"), "psi", "verdict")


@query
def drift_alert(s: Star) -> DataFrame:
    return drift.drift_alert(drift_report(s))


@query
def mix_drift(s: Star) -> DataFrame:
    return drift.mix_drift(s.sales, s.products)


@query
def stock_cover_naive(s: Star) -> DataFrame:
    return stock.stock_cover(s.products, naive_forecast(s))


# --- recommendation -----------------------------------------------------------------------------------

def _history(s: Star) -> DataFrame:
    return history.purchase_history(s.sales)


@query
def last_purchase_split(s: Star) -> DataFrame:
    return history.last_purchase(s.sales)


@query
def popularity(s: Star) -> DataFrame:
    return history.popularity(s.sales)


@query
def popular_recs(s: Star) -> DataFrame:
    sales = _stored_sales(s, "client_id", "product_id")
    bought = materialize(history.purchase_history(sales), "history")
    return history.popular_recs(bought, materialize(history.popularity(sales), "popularity"), K)


@query
def similar_products(s: Star) -> DataFrame:
    return similarity.similar_products(s.products, K)


@query
def bought_together(s: Star) -> DataFrame:
    return similarity.bought_together(materialize(_history(s), "history"), K)


@query
def cf_recs(s: Star) -> DataFrame:
    return recommend.recommend(_history(s), s.products, K, {"collaborative": 1.0})


@query
def content_recs(s: Star) -> DataFrame:
    return recommend.recommend(_history(s), s.products, K, {"content": 0.0})


@query
def hybrid_recs(s: Star) -> DataFrame:
    return recommend.recommend(_history(s), s.products, K, {"hybrid": 0.5})


@query
def client_recs_with_cold_start(s: Star) -> DataFrame:
    return recommend.recommend_or_popular(_with_unknown(s.clients.select("client_id")), s.sales, s.products, K)


@query
def served_recs(s: Star) -> DataFrame:
    """Models published as tables, then every client and an unknown one answered from those tables alone."""
    folder = fresh_path(s.spark, "models")
    reports.publish_models(_stored_sales(s, "client_id", "product_id"), s.products, folder)
    return reports.serve_recommendations(s.spark, folder, _with_unknown(s.clients.select("client_id")), K)


@query
def similar_products_requested(s: Star) -> DataFrame:
    return similarity.similar_to(_with_unknown(s.products.select("product_id")), s.products, K)


@query
def bought_together_named(s: Star) -> DataFrame:
    return recommend.with_names(bought_together(s), s.products, "neighbour_id")


@query
def client_history(s: Star) -> DataFrame:
    return history.client_history(_history(s), s.products, _with_unknown(s.clients.select("client_id")))


@query
def reco_evaluation(s: Star) -> DataFrame:
    return recommend.evaluate(s.sales, s.products, K)


# --- streams ---------------------------------------------------------------------------------------------

@query
def running_totals(s: Star) -> DataFrame:
    sales = s.sales.select("sale_id", "sale_date", "amount", F.lit(1).alias("one"))
    return with_running_sums(sales, ["sale_date", "sale_id"], {"total_sales": "one", "total_revenue": "amount"}) \
        .drop("one")


def _stream_paths(s: Star, label: str) -> tuple[str, str]:
    return fresh_path(s.spark, f"{label}-out"), fresh_path(s.spark, f"{label}-checkpoint")


@query
def stream_enriched(s: Star) -> DataFrame:
    """Sales streamed from files, enriched, sent as JSON messages to files, read back."""
    out, checkpoint = _stream_paths(s, "enriched")
    sales_stream.run_append(
        sales_stream.encode(sales_stream.enrich(s.sales_stream(), s.products)), out, checkpoint, "text")
    return sales_stream.decode(s.spark.read.text(out))


def _live_events(s: Star) -> DataFrame:
    return sales_stream.decode(sales_stream.encode(sales_stream.enrich(s.sales_stream(), s.products)))


@query
def stream_totals_by_category(s: Star) -> DataFrame:
    out, checkpoint = _stream_paths(s, "categories")
    sales_stream.run_complete(sales_stream.totals_by_category(_live_events(s)), out, checkpoint)
    return sales_stream.read_current(s.spark, out).orderBy(F.desc("n_sales"), "category")


@query
def stream_totals(s: Star) -> DataFrame:
    out, checkpoint = _stream_paths(s, "totals")
    sales_stream.run_complete(sales_stream.totals(_live_events(s)), out, checkpoint)
    return sales_stream.read_current(s.spark, out)


@query
def stream_running_totals(s: Star) -> DataFrame:
    out, checkpoint = _stream_paths(s, "running")
    live = _live_events(s).select("sale_id", "sale_date", "amount")
    sales_stream.run_running_totals(live, out, checkpoint, ["sale_date", "sale_id"])
    return s.spark.read.parquet(f"{out}/rows").drop("batch")


# --- forecast models ---------------------------------------------------------------------------------------

def _model_rows(s: Star) -> DataFrame:
    dense = materialize(daily_demand_dense(s), "dense")
    return materialize(forecast.evaluation_forecasts(dense, s.promotions), "forecasts")


@query
def model_forecast(s: Star) -> DataFrame:
    return _model_rows(s).withColumn("yhat", F.round("yhat", 4))


@query
def forecast_comparison(s: Star) -> DataFrame:
    return series.model_comparison(_model_rows(s))


@query
def forecast_experiments(s: Star) -> DataFrame:
    return series.experiment_table(_model_rows(s))


@query
def published_forecast(s: Star) -> DataFrame:
    return forecast.published_forecast(materialize(daily_demand(s), "demand"))


@query
def forecast_view(s: Star) -> DataFrame:
    """All actuals, the forecast and its band of every category."""
    rows = materialize(published_forecast(s), "published")
    return forecast.forecast_view(rows, None)


@query
def stock_cover_forecast(s: Star) -> DataFrame:
    rows = materialize(published_forecast(s), "published")
    return stock.stock_cover(s.products, rows.where(F.col("kind") == "forecast"))


@query
def scorecard(s: Star) -> DataFrame:
    return metrics.scorecard(forecast_comparison(s), optimal_price_by_category(s), reco_evaluation(s))
