"""Short looks at large tables: the first rows of an order, and a seeded sample that is the same on every run.

Both keep a bounded heap per task and merge the heaps; no row outside them is sorted or moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_rows(df: DataFrame, rows: int, *order: str | Column) -> DataFrame:
    """The first ``rows`` in ``order``, whose columns together should identify a row."""
    return df.orderBy(*order).limit(rows)


def sample_key(seed: int, *key: str) -> Column:
    """A hash of the seed and the key columns; a null counts as an empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))


def seeded_sample(df: DataFrame, rows: int, *key: str, seed: int = 42) -> DataFrame:
    """``rows`` rows of the smallest hashes of ``key``: every key is as likely as any other, whatever the partitions."""
    return df.withColumn("_sample", sample_key(seed, *key)).orderBy("_sample", *key).limit(rows).drop("_sample")
