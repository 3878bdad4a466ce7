"""What the optimiser makes of the queries: pruned scans, no pairwise joins, no row-wise Python."""

import re

import pytest

from tradewind.plans.queries import QUERIES

LAZY = ["revenue_by_category", "top_products", "kpi_summary", "revenue_by_city", "segment_offers", "daily_demand",
        "promo_impact_sales_flag", "promo_lift_calendar", "monthly_units_revenue", "elasticity_by_category",
        "product_prices", "price_what_if", "sales_profile", "event_profile", "clean_sales", "orphan_keys"]


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins_or_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in text


def test_scans_read_only_what_is_needed(spark, sf_dir):
    text = plan(QUERIES["revenue_by_category"](spark, sf_dir))
    physical = text[text.index("== Physical Plan =="):]
    read = {m for schema in re.findall(r"ReadSchema: struct<([^>]*)>", physical) for m in re.findall(r"(\w+):", schema)}
    assert read == {"l_orderkey", "l_partkey", "l_quantity", "l_discount", "o_orderkey", "p_partkey", "p_retailprice", "p_type"}


def test_top_products_needs_no_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_products"](spark, sf_dir))


def test_neighbour_ranks_are_limited_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(QUERIES["bought_together"](spark, sf_dir))
