"""Error metrics, optimal price, drift index and series rules on hand-made rows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.functions import text
from tradewind.functions.running import exact_quantiles, with_running_sums
from tradewind.operators import drift, metrics, pricing, profile, quality, series, stock


def errors(spark, y, yhat):
    df = spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(y, yhat)], "category string, y double, yhat double")
    return series.forecast_errors(df, "category").first()


def test_error_metrics(spark):
    assert errors(spark, [1, 2, 3], [1, 2, 3]).mae == 0.0
    assert errors(spark, [2, 2], [1, 3]).mae == 1.0
    far = errors(spark, [0, 0], [0, 10])
    assert far.rmse > far.mae and far.mape is None
    assert round(errors(spark, [100, 100], [110, 90]).mape, 1) == 10.0
    assert errors(spark, [0, 100], [5, 110]).mape == pytest.approx(10.0)


def test_optimal_price(spark):
    df = spark.createDataFrame([(100.0, -2.5), (100.0, -1.0), (100.0, -0.5)], "c double, e double")
    got = [r[0] for r in df.select(pricing.optimal_price(F.col("c"), F.col("e"))).collect()]
    assert round(got[0], 1) == 166.7 and got[1:] == [None, None]


def psi(spark, ref, rec):
    rows = [(float(v), False, 1) for v in ref] + [(float(v), True, 1) for v in rec]
    return drift.numeric_psi(spark.createDataFrame(rows, "v double, recent boolean, n bigint"), "v").first().psi


def numpy_psi(ref, rec, bins=10):
    edges = np.quantile(ref, np.linspace(0, 1, bins + 1))[1:-1]
    share = lambda x: np.maximum(np.bincount(np.searchsorted(edges, x, side="right"), minlength=bins) / len(x), 1e-4)
    a, b = share(ref), share(rec)
    return float(np.sum((b - a) * np.log(b / a)))


def test_psi(spark):
    r = np.random.default_rng(0)
    same = r.normal(size=1000)
    assert psi(spark, same, same) < 1e-6
    a, b = r.normal(0, 1, 500), r.normal(3, 1, 500)
    assert psi(spark, a, b) > 0.25
    assert psi(spark, a, b) == pytest.approx(numpy_psi(a, b))
    tied_a, tied_b = r.integers(0, 5, 300), r.integers(1, 7, 200)
    assert psi(spark, tied_a, tied_b) == pytest.approx(numpy_psi(tied_a, tied_b))


def test_drift_cut_and_verdict(spark):
    df = spark.sql("SELECT explode(array(DATE '2026-06-30', DATE '2026-03-30', DATE '2026-03-29')) AS sale_date")
    assert [r.recent for r in drift.split_recent(df).collect()] == [True, True, False]
    v = spark.createDataFrame([(0.0999,), (0.1,), (0.25,)], "p double").select(drift.verdict(F.col("p")))
    assert [r[0] for r in v.collect()] == ["stable", "moderate drift", "important drift"]
    alert = drift.drift_alert(spark.createDataFrame([(0.25,)], "psi double")).first().alert
    assert alert == "watch"


@pytest.mark.parametrize("values", [[5], [1, 2], [3, 3, 3, 3], list(range(50)), [1, 1, 2, 9, 9, 9, 40]])
def test_quantiles(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    want = np.quantile(values, probs)
    got = [r.edge for r in exact_quantiles(df, "v", probs).orderBy("idx").collect()]
    assert got == pytest.approx(list(want))


def test_running_sums_with_a_hot_day(spark):
    rows = [(1 if i % 3 else i % 50, i, i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "day int, id int, amount bigint")
    got = with_running_sums(df, ["day", "id"], {"total": "amount"}).orderBy("day", "id").collect()
    assert [r.total for r in got] == list(np.cumsum([r[2] for r in sorted(rows)]))


def day(i):
    return dt.date(2025, 1, 1) + dt.timedelta(days=i)


def test_densify_and_rolling(spark):
    demand = spark.createDataFrame([("a", day(0), 6), ("a", day(2), 3), ("b", day(3), 1)],
                                   "category string, ds date, units bigint")
    dense = series.densify(demand)
    got = {(r.category, r.ds): r.units for r in dense.collect()}
    assert len(got) == 8 and got["a", day(1)] == 0 and got["b", day(0)] == 0 and got["b", day(3)] == 1
    means = [r.units_mean7 for r in series.rolling_demand(dense).where("category = 'a'").orderBy("ds").collect()]
    assert means == [6.0, 3.0, 3.0, 2.25]


def test_campaign_days(spark):
    promos = spark.sql("""SELECT * FROM VALUES (0, 0.9D, NULL, NULL), (1, 0.1D, DATE '2025-01-01', DATE '2025-01-03'),
        (2, 0.3D, DATE '2025-01-03', DATE '2025-01-04'), (3, 0.5D, DATE '2025-02-02', DATE '2025-02-01')
        AS t(promo_id, rate, start_date, end_date)""")
    got = {r.ds: r.promo_rate for r in series.campaign_days(promos).collect()}
    assert got == {day(0): 0.1, day(1): 0.1, day(2): 0.3, day(3): 0.3}


def test_age_band_edges(spark):
    df = spark.createDataFrame([(a,) for a in (17, 18, 25, 26, 75, 76, None)], "age int")
    assert {r.band: r.clients for r in profile.age_bands(df).collect()} == {"18-25": 2, "26-35": 1, "56-75": 1}


def test_elasticity_with_a_missing_side(spark):
    states = spark.createDataFrame(
        [("a", False, 10.0, 5.0, 4.0), ("a", True, 8.0, 5.0, 8.0), ("b", False, 10.0, 5.0, 4.0)],
        "category string, on_promo boolean, price double, cost double, units_per_day double")
    got = {r.category: r.elasticity for r in pricing.elasticity(states).collect()}
    assert got["a"] == pytest.approx(np.log(2) / np.log(0.8)) and got["b"] is None
    advice = {r.category: r for r in pricing.price_advice(states).collect()}
    assert advice["b"].optimal_price is None and advice["a"].optimal_price is not None


def test_unknown_product_price(spark):
    prices = spark.createDataFrame([(1, "n", "c", 100, 50, -2.0, 110.0)],
                                   "product_id int, name string, category string, current_price bigint, cost bigint,"
                                   " elasticity double, optimal_price double")
    got = {r.product_id: r for r in pricing.price_lookup(prices, spark.createDataFrame([(1,), (9,)], "product_id int")).collect()}
    assert got[1].found and got[1].change_pct == 10.0 and not got[9].found and got[9].name is None


def test_no_views_and_no_stock_give_null(spark):
    sales = spark.createDataFrame([("1", 1, 1, 0, day(0), 1, 10, 10)],
                                  "sale_id string, client_id int, product_id int, promo_id int, sale_date date,"
                                  " quantity int, unit_price bigint, amount bigint")
    products = spark.createDataFrame([(1, 4, 0)], "product_id int, unit_cost bigint, stock int")
    events = spark.createDataFrame([], "action string")
    row = metrics.kpi_summary(sales, products, events).first()
    assert row.margin == 6 and row.conversion_pct is None and row.stock_turn is None


def test_indicators_leave_out_sales_of_unknown_products(spark):
    sales = spark.createDataFrame(
        [("1", 1, 1, 0, day(0), 1, 10, 10), ("2", 2, 9, 0, day(0), 1, 50, 50), ("3", 3, None, 0, day(0), 1, 50, 50)],
        "sale_id string, client_id int, product_id int, promo_id int, sale_date date, quantity int, unit_price bigint,"
        " amount bigint")
    products = spark.createDataFrame([(1, 4, 2)], "product_id int, unit_cost bigint, stock int")
    events = spark.createDataFrame([("view",), ("view",)], "action string")
    row = metrics.kpi_summary(sales, products, events).first()
    assert (row.revenue, row.margin, row.units, row.clients, row.orders) == (10, 6, 1, 1, 1)
    assert (row.mean_basket, row.conversion_pct, row.margin_per_client) == (10.0, 50.0, 6.0)


def test_cover_without_demand(spark):
    products = spark.createDataFrame([("a", 10), ("b", 10)], "category string, stock int")
    forecast = spark.createDataFrame([("a", day(0), -1.0), ("b", day(0), 1.0)], "category string, ds date, yhat double")
    got = {r.category: (r.cover_days, r.status) for r in stock.stock_cover(products, forecast).collect()}
    assert got == {"a": (None, "overstock"), "b": (10.0, "shortage risk")}


def test_each_quality_rule_finds_its_bad_row(spark):
    products = spark.createDataFrame([(1, 100), (1, 100)], "product_id int, list_price bigint")
    clients = spark.createDataFrame(
        [(1, 30, day(5)), (1, 30, day(5)), (2, 17, day(0)), (None, None, None)], "client_id int, age int, signup_date date")
    promotions = spark.createDataFrame([(0, 0.0), (1, 1.5), (2, None)], "promo_id int, rate double")
    sales = spark.createDataFrame([
        ("s1", 2, 1, 0, day(10), 1, 50, 50), ("s1", 2, 1, 0, day(10), 0, 50, 0), ("s2", 2, 1, 0, day(10), 1, -1, -1),
        ("s3", 2, 1, 0, day(10), 2, 50, 99), ("s4", 2, 1, 0, day(10), 1, 101, 101), ("s5", 2, 1, 0, day(99), 1, 50, 50),
        ("s6", 1, 1, 0, day(1), 1, 50, 50), ("s7", 9, 1, 0, day(10), 1, 50, 50), ("s8", 2, 9, 0, day(10), 1, 50, 50),
        ("s9", 2, 1, 9, day(10), 1, 50, 50), (None, None, 1, 0, None, None, None, None)],
        "sale_id string, client_id int, product_id int, promo_id int, sale_date date, quantity int, unit_price bigint, amount bigint")
    events = spark.createDataFrame([(1, 2, 1, "view"), (1, 9, None, "jump"), (2, 2, 1, None)],
                                   "event_id int, client_id int, product_id int, action string")
    report = quality.quality_report(products, clients, promotions, sales, events, ("2025-01-01", "2025-01-31"))
    got = {(r.family, r.rule): r.anomalies for r in report.collect()}
    want = {
        ("unique keys", "products.product_id"): 1, ("unique keys", "clients.client_id"): 2,
        ("unique keys", "sales.sale_id"): 2, ("unique keys", "events.event_id"): 1,
        ("keys present", "clients.client_id"): 1, ("keys present", "sales.sale_id"): 1,
        ("foreign keys", "sales.client_id in clients"): 2, ("foreign keys", "sales.product_id in products"): 1,
        ("foreign keys", "sales.promo_id in promotions"): 1, ("foreign keys", "events.client_id in clients"): 1,
        ("foreign keys", "events.product_id in products"): 1,
        ("values", "quantity > 0"): 1, ("values", "unit_price > 0"): 1, ("values", "amount = unit_price * quantity"): 1,
        ("values", "age 18 to 75"): 1, ("values", "rate 0 to 1"): 1, ("values", "known action"): 1,
        ("dates", "sale inside the window"): 1, ("funnel", "more cart adds than sales"): 1,
    }
    assert {k: got[k] for k in want} == want
    assert len(got) == 21
    # the duplicated dimension rows count once per match, as a join does
    assert got["values", "unit_price <= list_price"] == 2 and got["dates", "no sale before signup"] == 2


def test_labels(spark):
    row = spark.range(1).select(
        text.month_label(F.lit("2026-02")).alias("m"), text.grouped_digits(F.lit(1234567.4)).alias("g"),
        text.signed_millions(F.lit(41_000_000)).alias("s")).first()
    assert (row.m, row.g, row.s) == ("Feb", "1 234 567", "+41,0 M")
