"""The retail star schema seen through a set of TPC-H-like Parquet tables.

Money stays in whole cents, so sums are exact in every engine.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The campaign calendar (0 is the "no promotion" row without dates).
CAMPAIGNS = """
    (0, 'none', 'none', 0.00D, NULL, NULL),
    (5, 'back to school', 'discount', 0.05D, DATE '1997-09-01', DATE '1997-09-30'),
    (6, 'clearance', 'clearance', 0.06D, DATE '1998-10-10', DATE '1998-10-20'),
    (7, 'black friday', 'flash', 0.07D, DATE '1998-11-24', DATE '1998-11-30'),
    (8, 'year end', 'sale', 0.08D, DATE '1999-12-15', DATE '1999-12-31'),
    (9, 'spring', 'discount', 0.09D, DATE '2000-03-18', DATE '2000-03-25'),
    (10, 'spring extra', 'code', 0.10D, DATE '2000-03-22', DATE '2000-04-05'),
    (11, 'summer', 'flash', 0.11D, DATE '2001-07-10', DATE '2001-07-20')
"""
# Discount in percent and aim per client segment.
SEGMENT_RULES = """
    ('AUTOMOBILE', 5, 'retention'),
    ('BUILDING', 5, 'retention'),
    ('FURNITURE', 8, 'reactivation'),
    ('HOUSEHOLD', 10, 'acquisition'),
    ('MACHINERY', 10, 'acquisition')
"""
SALES_WINDOW = ("1995-07-01", "2001-06-30")


def _full_sale_id() -> Column:
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return F.concat_ws("-", *parts, F.col("l_shipdate").cast("date").cast("string"))


class Star:
    """Lazy DataFrames of the five tables; unused columns are pruned at the scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def products(self) -> DataFrame:
        cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
        key = F.col("p_partkey")
        return self.raw("part").select(
            key.cast("bigint").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            cents.alias("list_price"),
            F.expr("cast(round(p_retailprice * 100) as bigint) * (55 + p_partkey % 26) div 100").alias("unit_cost"),
            (key * 37 % 300).cast("int").alias("stock"),
        )

    @cached_property
    def clients(self) -> DataFrame:
        key = F.col("c_custkey")
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("city"))
        return (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key.cast("bigint").alias("client_id"),
                F.col("c_name").alias("name"),
                (18 + key % 58).cast("int").alias("age"),
                "city",
                F.date_add(F.lit("1994-01-01").cast("date"), (key * 7 % 1000).cast("int")).alias("signup_date"),
                F.col("c_mktsegment").alias("segment"),
                F.concat(F.lit("channel-"), (key % 5).cast("string")).alias("channel"),
            )
        )

    @cached_property
    def sales(self) -> DataFrame:
        return self._sales(_full_sale_id())

    @cached_property
    def raw_sales(self) -> DataFrame:
        """Sales keyed by order and line, a key the source repeats."""
        return self._sales(F.concat_ws(
            "-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))

    def sales_stream(self) -> DataFrame:
        """The sales as a stream over the line item table, one file or a folder of files, joined with the static tables."""
        schema = self.raw("lineitem").schema  # also fails where there is no table
        # a stream takes a plain path for a folder; a pattern may match a folder or a single file
        lines = self.spark.readStream.schema(schema).parquet(f"{self.sf_dir}/lineitem.parque[t]")
        return self._sales(_full_sale_id(), lines)

    def _sales(self, sale_id, lines: DataFrame | None = None) -> DataFrame:
        pct = F.round(F.col("l_discount") * 100).cast("int")
        promo = F.when(pct >= 5, pct).otherwise(F.lit(0))
        lines = (self.raw("lineitem") if lines is None else lines).withColumn("promo_id", promo)
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("o_custkey").cast("bigint").alias("client_id"),
            F.col("o_orderdate").cast("date").alias("sale_date"),
        )
        parts = self.raw("part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.round(F.col("p_retailprice") * 100).cast("bigint").alias("cents"),
        )
        quantity = F.col("l_quantity").cast("int")
        unit_price = F.expr("cents * (100 - promo_id) div 100")
        return (
            lines.join(orders, "l_orderkey").join(parts, "l_partkey")
            .select(
                sale_id.alias("sale_id"),
                "client_id",
                F.col("l_partkey").cast("bigint").alias("product_id"),
                "promo_id",
                "sale_date",
                quantity.alias("quantity"),
                unit_price.alias("unit_price"),
                (unit_price * quantity).alias("amount"),
            )
        )

    @cached_property
    def events(self) -> DataFrame:
        kind = F.col("event_type")
        viewed = F.regexp_extract("props", r'"k": ([0-9]+)', 1)
        return self.raw("events").select(
            "event_id",
            F.col("user_id").cast("bigint").alias("client_id"),
            F.when(~kind.isin("signup", "error"), viewed.try_cast("bigint")).alias("product_id"),
            "ts",
            F.when(kind == "purchase", F.lit("add_to_cart")).otherwise(kind).alias("action"),
        )

    @cached_property
    def promotions(self) -> DataFrame:
        return self.spark.sql(
            f"SELECT * FROM VALUES {CAMPAIGNS} AS t(promo_id, campaign, kind, rate, start_date, end_date)")

    @cached_property
    def city_coordinates(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.raw("nation").select(
            F.col("n_name").alias("city"), key.cast("double").alias("lat"), (-key).cast("double").alias("lon"))

    @cached_property
    def segment_rules(self) -> DataFrame:
        return self.spark.sql(f"SELECT * FROM VALUES {SEGMENT_RULES} AS t(segment, discount_pct, aim)")
