"""Mixing sources to target weights by Sainte-Laguë apportionment. DataFrame functions only.

* Targets: sources in code point order (null last) get the weights in turn and share all words; no target is above
  ``most`` times its source's size, and the excess is shared again by weight.
* Quotas: the words are blocks of BLOCK; sources get them by the highest quotients target / (2k - 1). Each source is cut
  into shards of a bounded number of documents (by a seeded hash), and its blocks are apportioned to its shards in the
  same way, by their sizes. So every shard has a whole number of blocks, and no shard depends on another's documents.
* Selection: a shard's documents are put on a line in seeded order. Its quota takes the whole line as often as it fits,
  then the line's beginning: the blocks that come first in seeded order.

Defined results: null text has no words; a document without words, or of a source without words, takes none. A null
source is a source of its own, the last. Repeated rows (same doc_id or not) are documents of their own: each is placed
on the line by hash, id and size, and ties share the same place and order, which of two equal rows is taken doesn't
show. An empty table gives an empty result. Columns ``size``, ``source_size``, ``target`` and ``taken`` of the input are
replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.storage import stored

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 8
SHARD_DOCS = 20_000
SEED = 17


def n_words(text: Column) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+`` in ``text``; 0 for null."""
    marks = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x"),
                             r"[\x20\x09-\x0D]+", "")
    return F.length(marks).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) with ``target``. One row per source goes through the windows.

    Raising a common level fills the sources in the order of most * size / weight, so with the sources in that order the
    first to stay below its cap fixes the level: what is left, over the weights left."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place + 1).cast("int"))
    weighed = sizes.withColumn("weight", w).withColumn("cap", (F.col("source_size") * most).cast("double"))
    everything = Window.partitionBy(F.lit(0))
    filling = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    fill = filling.rowsBetween(Window.unboundedPreceding, -1)
    left = (F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(fill), F.lit(0.0)))
    share = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fill), F.lit(0.0))
    open_level = F.when(left / share * F.col("weight") <= F.col("cap"), left / share)
    level = F.first("open_level", ignorenulls=True).over(
        filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    first = weighed.withColumn("open_level", open_level)
    return first.withColumn("target", F.least("cap", F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))).select(
        "source", "source_size", "target")


def apportion(parts: DataFrame, by: list[str], claim: str, seats: str) -> DataFrame:
    """``parts`` with ``quota``: the whole numbers that share ``seats`` (one number per group ``by``) among the rows of
    the group by Sainte-Laguë, ties in the order of ``tie``.

    A claim c has floor((c / q + 1) / 2) quotients of q or more, between c / 2q - 1/2 and c / 2q + 1/2. So with n claims
    that sum to t, at most ``seats`` quotients reach t / (2 seats - n) (none is above the largest claim), and at least
    ``seats`` reach t / (2 seats + n). Quotients above the first are certain, those below the second are out, and the at
    most 2n between them are ranked."""
    group = Window.partitionBy(*by)
    total, n = F.sum(claim).over(group), F.sum((F.col(claim) > 0).cast("bigint")).over(group)
    known = parts.withColumns({"_total": total.cast("double"), "_n": n, "_top": F.max(claim).over(group).cast("double")})
    tight = 2 * F.col(seats) - F.col("_n")
    high = F.when(tight > 0, F.least("_top", F.col("_total") / tight)).otherwise(F.col("_top")) * (1 + 1e-9)
    low = F.col("_total") / (2 * F.col(seats) + F.col("_n")) * (1 - 1e-9)
    reach = lambda q: F.when(F.col(claim) > 0, F.floor((F.col(claim) / q + 1) / 2)).otherwise(F.lit(0))
    sure = known.withColumns({"_sure": reach(high), "_most": reach(low)})
    sure = sure.withColumn("_open", F.col(seats) - F.sum("_sure").over(group))
    tried = sure.withColumn("_k", F.explode_outer(
        F.when(F.col("_most") > F.col("_sure"), F.sequence(F.col("_sure") + 1, F.col("_most")))))
    quotient = F.col(claim) / (2 * F.col("_k") - 1)
    rank = F.row_number().over(group.orderBy(quotient.desc_nulls_last(), "tie", "_k"))
    won = tried.withColumn("_won", (F.col("_k").isNotNull() & (rank <= F.col("_open"))).cast("bigint"))
    return won.groupBy(*parts.columns, "_sure").agg(F.sum("_won").alias("_won")).withColumn(
        "quota", F.col("_sure") + F.col("_won")).drop("_sure", "_won")


class Mix:
    """The quotas of all shards for the rows of ``docs`` (doc_id, text, source). The texts are read once, for their
    sizes; everything after that moves a few numbers per document."""

    def __init__(self, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED,
                 block: int = BLOCK):
        self.seed = seed
        lines = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), self._at()), "sizes")
        self.sources = stored(lines.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.count("*").alias("docs")), "sources")
        aims = targets(self.sources.select("source", "source_size"), weights, most)
        aims = (aims.withColumn("tie", F.col("source")).withColumn("all", F.lit(0))
                .withColumn("seats", F.floor(F.sum("source_size").over(Window.partitionBy("all")) / F.lit(block))))
        aims = apportion(aims, ["all"], "target", "seats").withColumnRenamed("quota", "source_quota").drop("tie", "seats", "all")
        self.dealt = stored(self._with_shard(lines), "shards")
        shards = self.dealt.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
        same = F.col("source").eqNullSafe(F.col("s_source"))
        plan = (shards.join(aims.withColumnRenamed("source", "s_source"), same).drop("s_source")
                .withColumn("tie", F.col("shard")).withColumn("claim", F.col("shard_size").cast("double")))
        plan = apportion(plan, ["source"], "claim", "source_quota")
        words = F.least(F.col("quota") * block, F.col("shard_size") * most)
        whole = F.when(F.col("shard_size") > 0, F.floor(words / F.col("shard_size"))).otherwise(F.lit(0))
        self.plan = stored(plan.select(
            F.col("source").alias("s_source"), F.col("shard").alias("s_shard"), "source_size", "target",
            whole.alias("whole"), (words - whole * F.col("shard_size")).alias("rest")), "quotas")

    def _at(self):
        return F.xxhash64(F.lit(self.seed), F.col("doc_id")).alias("at")

    def _with_shard(self, rows: DataFrame) -> DataFrame:
        of = self.sources.select(F.col("source").alias("s_source"), F.ceil(F.col("docs") / SHARD_DOCS).alias("_n"))
        shard = F.pmod(F.xxhash64(F.lit(self.seed + 1), F.col("doc_id")), F.col("_n"))
        return rows.join(of, F.col("source").eqNullSafe(F.col("s_source"))).withColumn("shard", shard).drop("s_source", "_n")

    def _planned(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.plan, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("shard") == F.col("s_shard")))

    def taken(self) -> DataFrame:
        """(doc_id, source, size, source_size, target, taken, whole, at, s_source, s_shard) per row of the input."""
        line = Window.partitionBy("source", "shard").orderBy("at", "doc_id", "size").rowsBetween(
            Window.unboundedPreceding, -1)
        placed = self.dealt.withColumn("before", F.coalesce(F.sum("size").over(line), F.lit(0)))
        part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
        return self._planned(placed).withColumn(
            "taken", (F.col("whole") * F.col("size") + part).cast("bigint")).withColumn("part", part)


def mix(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row per row of ``docs``."""
    return Mix(docs, **how).taken().select("doc_id", "source", "size", "source_size", "target", "taken")


def copies(docs: DataFrame, **how) -> DataFrame:
    """``docs`` as the mix has it: each document as often as its taken words fill it, to the nearest whole number, so
    only the document at the end of a shard's quota is rounded. Columns and texts stay as they are; documents without
    words, which add nothing to any share, stay once. Texts are not shuffled: what a shard takes is told by the last
    place on its line, and the table of shards is what joins them."""
    made = Mix(docs, **how)
    last = made.taken().where("part > 0 and 2 * part >= size").groupBy("s_source", "s_shard").agg(F.max("at").alias("last"))
    plan = made.plan.select(F.col("s_source").alias("p_source"), F.col("s_shard").alias("p_shard"), "whole")
    plan = stored(plan.join(last, F.col("p_source").eqNullSafe(F.col("s_source")) & (F.col("p_shard") == F.col("s_shard")),
                            "left").select("p_source", "p_shard", "whole", "last"), "places")
    named = [F.col(c).alias(f"d_{i}") for i, c in enumerate(docs.columns)]
    rows = made._with_shard(docs.select(*named, "source", "doc_id"))
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("shard") == F.col("p_shard")))
    often = F.col("whole") + (made._at() <= F.coalesce(F.col("last"), F.lit(-2**63))).cast("int")
    text = F.col(f"d_{docs.columns.index('text')}")
    often = F.when(F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]"), often).otherwise(F.lit(1)).cast("int")
    rows = rows.withColumn("_times", often).where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return rows.select(*[F.col(f"d_{i}").alias(c) for i, c in enumerate(docs.columns)])
