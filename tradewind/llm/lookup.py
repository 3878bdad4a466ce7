"""Fetch the rows of a large table whose ids are in another table, without shuffling the rest of its texts.

The wanted ids are hashed into a bitmap of fixed size (2^BITS bits, whatever the input), which every scan task gets.
What passes it is joined exactly. With very many wanted ids the bitmap lets most rows pass; the result is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24


def _spot(key: str):
    """The place of a key in the bitmap, from 1."""
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(1 << BITS)) + 1


def _marked(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``table`` with ``_lookup_hit``: true for every row whose key is in ``ids`` and for a few others. The bitmap is at most 2^9
    rows of 4 kB, 2 MB together."""
    bitmap = ids.select(_spot(key).alias("v")).groupBy(F.bitmap_bucket_number("v").alias("_lookup_row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("_lookup_bits"))
    at = F.bitmap_bit_position(_spot(key)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_lookup_bits"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    one = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), at.bitwiseAND(7) + 1)
    hit = F.coalesce(byte.bitwiseAND(one) != 0, F.lit(False)) & F.col(key).isNotNull()
    return (table.withColumn("_lookup_row", F.bitmap_bucket_number(_spot(key)))
            .join(F.broadcast(bitmap), "_lookup_row", "left").withColumn("_lookup_hit", hit))


def only_wanted(table: DataFrame, wanted: DataFrame, key: str = "doc_id", exact: bool = True) -> DataFrame:
    """Rows of ``table`` whose ``key`` is in column ``key`` of ``wanted``; null keys are in neither. Unless ``exact``, some
    other rows may pass too."""
    ids = wanted.select(F.col(key).alias("_lookup_id")).where("_lookup_id is not null").distinct()
    passed = _marked(table, ids.withColumnRenamed("_lookup_id", key), key).where("_lookup_hit")
    if not exact:
        return passed.select(*table.columns)
    return passed.join(ids, F.col(key) == F.col("_lookup_id"), "left_semi").select(*table.columns)


def without(table: DataFrame, unwanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``table`` whose ``key`` is not in column ``key`` of ``unwanted``; rows with a null key stay."""
    ids = unwanted.select(F.col(key).alias("_lookup_id")).where("_lookup_id is not null").distinct()
    marked = _marked(table, ids.withColumnRenamed("_lookup_id", key), key)
    checked = marked.where("_lookup_hit").join(ids, F.col(key) == F.col("_lookup_id"), "left_anti")
    return marked.where("not _lookup_hit").select(*table.columns).unionByName(checked.select(*table.columns))
