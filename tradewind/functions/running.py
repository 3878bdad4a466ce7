"""Totals over a global order, without one task seeing all rows.

The frame is range-partitioned on its order, written once, and each slice is summed
on its own; the offset of a slice is the sum of the slices before it. A hot day or a
hot value therefore spreads over as many slices as it needs, provided that the order
columns together identify a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.functions.storage import materialize


def with_running_sums(df: DataFrame, order: list[str], sums: dict[str, str]) -> DataFrame:
    """Add running sums ``{new column: summed column}`` in ascending ``order``."""
    # as many slices as the session's shuffles have tasks: left to itself, Spark would join small ones into one task
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = materialize(
        df.repartitionByRange(slices, *order).withColumn("slice_no", F.spark_partition_id()), "slices")
    per_slice = sliced.groupBy("slice_no").agg(*[F.sum(c).alias(f"total_{n}") for n, c in sums.items()])
    # one row per slice: bounded by the number of shuffle partitions
    before = W.partitionBy(F.lit(0)).orderBy("slice_no").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_slice.select("slice_no", *[
        F.coalesce(F.sum(f"total_{n}").over(before), F.lit(0)).alias(f"offset_{n}") for n in sums])
    within = W.partitionBy("slice_no").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return sliced.join(offsets, "slice_no").select(
        *df.columns,
        *[(F.sum(c).over(within) + F.col(f"offset_{n}")).alias(n) for n, c in sums.items()])


def exact_quantiles(df: DataFrame, value: str, probs: list[float], weight: str | None = None) -> DataFrame:
    """Quantiles with linear interpolation as rows ``(idx, edge)``.

    Works on distinct values with their counts, so repeats collapse on the map side, ranked by a
    distributed running sum whatever their number. ``weight`` names a column saying how often a row counts.
    """
    times = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(times.alias("n"))
    ranked = with_running_sums(counts, [value], {"upto": "n"})
    total = ranked.agg(F.max("upto").alias("t")).scalar()
    places = F.explode(F.array(*[
        F.struct(F.lit(i).alias("idx"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])).alias("q")
    spots = ranked.select(
        F.col(value).cast("double").alias("v"), "upto", (F.col("upto") - F.col("n")).alias("below"),
        (total - 1).alias("last"), places)
    at = F.col("q.p") * F.col("last")
    lo = F.floor(at)
    # a value covers the 0-based ranks below .. upto-1
    covers = lambda r: (F.col("below") <= r) & (r < F.col("upto"))
    hi = F.least(lo + 1, F.col("last"))
    ends = spots.where(covers(lo) | covers(hi)).groupBy("q.idx", "q.p", "last").agg(
        F.max(F.when(covers(lo), F.col("v"))).alias("a"), F.max(F.when(covers(hi), F.col("v"))).alias("b"))
    frac = F.col("p") * F.col("last") - F.floor(F.col("p") * F.col("last"))
    return ends.select("idx", (F.col("a") + (F.col("b") - F.col("a")) * frac).alias("edge"))
