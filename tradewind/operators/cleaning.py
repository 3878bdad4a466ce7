"""Key cleaning and the counts that go with it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """Drop rows with a null key and keep the smallest row of every key.

    ``min`` over a struct combines on the map side, so a key that holds a large
    share of the rows shrinks to one row per task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    with_key = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    if not rest:
        return with_key.distinct()
    smallest = with_key.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row"))
    return smallest.select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns])


def key_audit(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows read, kept and removed by :func:`one_row_per_key`, per table."""
    def audit(name: str, df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return per_key.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_read"),
            F.count(key).alias("rows_kept"),
        )
    counts = reduce(DataFrame.unionByName, [audit(n, df, k) for n, (df, k) in tables.items()])
    return counts.withColumn("rows_removed", F.col("rows_read") - F.col("rows_kept"))
