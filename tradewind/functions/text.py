"""Report formatting: month labels and grouped numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month labels of the revenue chart.
MONTH_LABELS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
                "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def month_label(month_key: Column) -> Column:
    """``YYYY-MM`` to a short month name."""
    return F.element_at(
        F.array(*[F.lit(m) for m in MONTH_LABELS]),
        F.substring(month_key, 6, 2).cast("int"),
    )


# Names of the monitored indicators in the report.
INDICATOR_LABELS = {
    "daily_demand": "Demand per day",
    "unit_price": "Sale price",
    "category_mix": "Category mix",
}


def indicator_label(indicator: Column) -> Column:
    """The report's name of an indicator; an unknown one keeps its own."""
    named = F.create_map(*[F.lit(x) for pair in INDICATOR_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(named, indicator), indicator)


def grouped_digits(amount: Column) -> Column:
    """``1234567.4`` to ``1 234 567``."""
    return F.regexp_replace(F.format_number(F.bround(amount, 0), 0), ",", " ")


def signed_millions(amount: Column) -> Column:
    """``41000000`` to ``+41,0 M``."""
    return F.concat(
        F.when(amount >= 0, F.lit("+")).otherwise(F.lit("")),
        F.regexp_replace(F.format_string("%.1f", amount.cast("double") / F.lit(1e6)), r"\.", ","),
        F.lit(" M"),
    )
