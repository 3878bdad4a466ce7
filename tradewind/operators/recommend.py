"""Personal recommendations: collaborative, content and hybrid scores for all clients, in Spark operators alone.

The score of a product for a client sums its similarity to everything the client bought.

* Collaborative sums are sparse, and no pair of products reaches a shuffle. A similarity is the number of common buyers over
  the roots of both numbers of buyers, so the sum over a history is one over the baskets of the clients that share a purchase:
  each weighs what is shared, and every product in it gets that weight. For products that many clients have (and for given
  similarities) the list of products bought along is made once instead, as short as the catalogue. Both go to the task
  of a shard of clients as two short lists, and are spread and summed there.
* The products of one block are scored first; the last place of a client's best there is a bar for all the others, and only
  what reaches it is sorted.
* The smallest collaborative score over all unbought products is 0 exactly if fewer products have a score than are unbought;
  otherwise it is the smallest of those that have one. They are counted only for clients that have so many entries in lists.
* Content scores are found in bands: neighbours in price within one category and brand. Over a band the score of a client is
  bounded by its ends and its peak, so only bands that may hold one of the best, or the least, are opened; first wide bands, then
  narrow ones.
* A hybrid list merges the best of both lists. No product outside them can score more than the last places of both do
  together; clients for whom this bound is not below their k-th score are scored again with deeper lists.
* Clients are scored in batches, so that what is sent and stored on the way stays a few times the history; it is removed before
  the next batch.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.functions.numeric import EDGE_BITS, checked_k, dbl, fixed_point, ratio
from tradewind.functions.running import with_running_sums
from tradewind.functions.spread import spread_join
from tradewind.functions.storage import materialize, settings, settled
from tradewind.operators.history import leave_last_out, popular_recs, popularity, purchase_history
from tradewind.operators.similarity import baskets, bought_by, content_features, from_both_ends

CELLS = 2_000_000           # scores of single pairs summed in one task, about
BLOCKS = 16                 # blocks of products, at least of BLOCK_PRODUCTS each
BLOCK_PRODUCTS = 1024
MANY, FEW = 20_000, 4       # a product has a list of its own if its buyers bought more than MANY, or a FEWth of the catalogue
PIECE = 65_536              # products in one piece of such a list
NARROW = 16                 # products in a narrow band
SENT = 64                   # entries of lists sent in one batch of clients, for each row of the history
BANDS = 2                   # bands judged in one batch, for each row of the history
BATCH_LEAST = 20_000_000    # entries or bands that one batch may have in any case
DEPTH = 256                 # length of the lists that a hybrid list merges first

MODELS = {"content": 0.0, "collaborative": 1.0, "hybrid": 0.5}
HALF = EDGE_BITS // 2
SCALE = float(1 << EDGE_BITS)


def _halves(n: Column, fixed: Column) -> list[Column]:
    """Sums of ``n * fixed`` in two halves, exact up to 2^37 purchases and free of order."""
    return [F.sum(n * F.shiftright(fixed, HALF)).alias("upper"), F.sum(n * fixed.bitwiseAND(F.lit((1 << HALF) - 1))).alias("lower")]


def _whole() -> Column:
    return (F.col("upper").cast("double") * dbl(1 << HALF) + F.col("lower").cast("double")) / dbl(SCALE)


def _min_max(score: str, low: str, high: str) -> Column:
    """Min-max per client; a client whose scores are all equal gets 0."""
    spread = F.col(high) - F.col(low)
    return F.when(spread > 0, (F.col(score) - F.col(low)) / spread).otherwise(dbl(0))


# --- content ------------------------------------------------------------------------------------------


class Catalogue:
    """Products in bands, written once: ``products`` (product_id, category, brand, p, m, band, narrow), ``bands`` and ``narrow``."""

    def __init__(self, products: DataFrame) -> None:
        self.size = products.count()
        width = max(16, min(4096, math.isqrt(self.size)))
        order = ["category", "brand", "p", "product_id"]
        placed = with_running_sums(content_features(products).withColumn("one", F.lit(1)), order, {"number": "one"})
        placed = materialize(placed.drop("one").withColumn("slot", F.floor(F.col("number") / F.lit(width))), "price-order")
        bands = placed.groupBy("category", "brand", "slot").agg(
            F.min("number").alias("band"), F.min("m").alias("m"), F.min("p").alias("lo"), F.max("p").alias("hi"),
            F.count(F.lit(1)).alias("size"))
        self.bands = materialize(bands, "bands")
        b = self.bands.select("band", "slot", F.col("category").alias("_category"), F.col("brand").alias("_brand"))
        here = F.col("category").eqNullSafe(F.col("_category")) & F.col("brand").eqNullSafe(F.col("_brand"))
        self.products = materialize(
            placed.join(b, "slot").where(here).select(
                "product_id", "category", "brand", "p", "m", "band",
                (F.col("band") + F.floor((F.col("number") - F.col("band")) / F.lit(NARROW)) * NARROW).alias("narrow")), "banded")
        self.narrow = materialize(self.products.groupBy("band", "narrow").agg(
            F.min("m").alias("m"), F.min("p").alias("lo"), F.max("p").alias("hi"), F.count(F.lit(1)).alias("size")), "narrow-bands")


def _profile(history: DataFrame, feats: DataFrame) -> DataFrame:
    """(client_id, kind, name, v): summed weights of a client's categories, brands and, as kind ``price``, prices."""
    norm = F.sqrt(F.col("m") + F.col("p") * F.col("p"))
    weight = F.coalesce(ratio(dbl(1), norm), dbl(0))
    fixed = lambda c: fixed_point(c, 1 << EDGE_BITS)
    # without attributes the norm is the price itself, and the weight of nothing
    part = lambda kind, name, w: F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"), w.alias("w"))
    attribute = fixed(F.least(weight, dbl(1)))
    parts = F.array(part("category", F.col("category"), attribute), part("brand", F.col("brand"), attribute),
                    part("price", F.lit(""), fixed(F.col("p") * weight)))
    rows = history.join(feats, "product_id").select("client_id", "n", F.inline(parts)).where("name is not null")
    return rows.groupBy("client_id", "kind", "name").agg(*_halves(F.col("n"), F.col("w"))) \
        .select("client_id", "kind", "name", _whole().alias("v"))


def _content_at(a: Column, price: Column, p: Column, m: Column) -> Column:
    """The score ``(a + P p) / sqrt(m + p^2)``; 0 for a product without attributes and price."""
    return F.coalesce(ratio(a + price * p, F.sqrt(m + p * p)), dbl(0))


def content_scores(history: DataFrame, profile: DataFrame, shop: Catalogue, depth: int) -> DataFrame:
    """(client_id, product_id, ct) of unbought products: among them each client's ``depth`` best, and its worst."""
    weight = lambda kind: profile.where(F.col("kind") == kind).select("client_id", "name", "v")
    touched = [weight(kind).join(shop.bands.select(F.col(kind).cast("string").alias("name"), "band"), "name").select("client_id", "band", "v")
               for kind in ("category", "brand")]
    touched = touched[0].unionByName(touched[1]).groupBy("client_id", "band").agg(F.sum("v").alias("a"))
    touched = materialize(touched, "touched-bands")
    # bands that share nothing with a client are all alike but for their price: the first in order of it will do
    n_bands = shop.bands.count()
    clients = profile.where("kind = 'price'").select("client_id", F.col("v").alias("price"))
    full = touched.groupBy("client_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= n_bands).select("client_id")
    open_clients = materialize(clients.join(full, "client_id", "left_anti"), "open-clients")
    rows = [touched]
    if not open_clients.isEmpty():
        seen = touched.join(open_clients, "client_id", "left_semi").select("client_id", F.col("band").alias("product_id"))
        seen = open_clients.select("client_id", F.lit(-1).cast("bigint").alias("product_id")).unionByName(seen)
        bare = lambda c: _content_at(dbl(0), dbl(1), F.col(c), F.col("m"))
        for key, k in ((-bare("hi"), depth), (bare("lo"), 1)):
            listed = shop.bands.select(key.alias("key"), F.col("band").alias("product_id"), F.lit(1).alias("one"))
            ranked = materialize(with_running_sums(listed, ["key", "product_id"], {"rank": "one"}).select("rank", "product_id"), "band-order")
            # a place before all others, which every client has taken, so that each of them is seen
            ranked = ranked.select((F.col("rank") + 1).alias("rank"), "product_id").unionByName(
                ranked.sparkSession.range(1).select(F.lit(1).cast("bigint").alias("rank"), F.lit(-1).cast("bigint").alias("product_id")))
            rows.append(popular_recs(seen, ranked, k).select("client_id", F.col("product_id").alias("band"), dbl(0).alias("a")))
    bought = spread_join(history, shop.products.select("product_id", "band", "narrow"), ["product_id"])
    bought = materialize(bought.select("client_id", "product_id", "band", "narrow"), "bought-in")
    every = rows[0]
    for r in rows[1:]:
        every = every.unionByName(r)
    every = every.dropDuplicates(["client_id", "band"]) if len(rows) > 1 else every
    wide = every.join(clients, "client_id").join(shop.bands.select("band", "m", "lo", "hi", "size"), "band")
    opened = materialize(_opened(wide, bought, "band", depth), "opened-bands")
    # a good band is opened by many clients
    close = spread_join(opened, shop.narrow, ["band"])
    opened = materialize(_opened(close, bought, "narrow", depth), "opened-narrow")
    return spread_join(opened, shop.products.select("narrow", "product_id", "p", "m"), ["narrow"]) \
        .join(bought.select("client_id", "product_id"), ["client_id", "product_id"], "left_anti") \
        .select("client_id", "product_id", _content_at(F.col("a"), F.col("price"), F.col("p"), F.col("m")).alias("ct"))


def _opened(rows: DataFrame, bought: DataFrame, band: str, depth: int) -> DataFrame:
    """Of ``rows`` (client_id, band, a, price, m, lo, hi, size) the bands that may hold one of a client's ``depth`` best, or its
    worst: (client_id, band, a, price)."""
    bought_in = bought.groupBy("client_id", band).agg(F.count(F.lit(1)).alias("n_bought"))
    rows = rows.join(bought_in, ["client_id", band], "left") \
        .withColumn("free", F.col("size") - F.coalesce("n_bought", F.lit(0))).where("free > 0")
    at = lambda c: _content_at(F.col("a"), F.col("price"), F.col(c), F.col("m"))
    peak = ratio(F.col("price") * F.col("m"), F.col("a"))
    top = F.sqrt(ratio(F.col("a") * F.col("a"), F.col("m")) + F.col("price") * F.col("price"))
    inside = (peak > F.col("lo")) & (peak < F.col("hi"))
    bounds = rows.select("client_id", band, "a", "price", "free", F.least(at("lo"), at("hi")).alias("least"),
                         F.greatest(at("lo"), at("hi"), F.when(inside, top)).alias("most"))
    each = W.partitionBy("client_id")
    by_least = each.orderBy(F.desc("least"), band).rowsBetween(W.unboundedPreceding, -1)
    # the bands that surely hold ``depth`` products set the score below which nothing is among the best
    judged = bounds.withColumn("ahead", F.coalesce(F.sum("free").over(by_least), F.lit(0))) \
        .withColumn("bar", F.min(F.when(F.col("ahead") < depth, F.col("least"))).over(each)) \
        .withColumn("floor", F.min("most").over(each))
    slack = 1e-12
    return judged.where((F.col("most") * dbl(1 + slack) >= F.col("bar")) | (F.col("least") * dbl(1 - slack) <= F.col("floor"))) \
        .select("client_id", band, "a", "price")


def with_content(pairs: DataFrame, profile: DataFrame, shop: Catalogue) -> DataFrame:
    """``pairs`` (client_id, product_id, ...) with their content score ``ct``."""
    kinds = [profile.where(F.col("kind") == kind).select("client_id", F.col("name").alias(kind), F.col("v").alias(f"of_{kind}"))
             for kind in ("category", "brand")]
    price = profile.where("kind = 'price'").select("client_id", F.col("v").alias("price"))
    feats = shop.products.select("product_id", F.col("category").cast("string").alias("category"),
                                 F.col("brand").cast("string").alias("brand"), "p", "m")
    both = pairs.join(feats, "product_id").join(kinds[0], ["client_id", "category"], "left") \
        .join(kinds[1], ["client_id", "brand"], "left").join(price, "client_id")
    a = F.coalesce("of_category", dbl(0)) + F.coalesce("of_brand", dbl(0))
    return both.select(*pairs.columns, _content_at(a, F.col("price"), F.col("p"), F.col("m")).alias("ct"))


# --- collaborative ------------------------------------------------------------------------------------

BOUGHT, WANTED = -1, -2     # in place of an entry's code: a product the client has, one whose score is asked for
HAD, ASKED = 1 << 62, 1 << 61
#: Sums of more keys than a small first map holds are faster without it.
ONE_MAP = {"spark.sql.codegen.aggregate.map.twolevel.enabled": "false"}
TIMES_AT = 31               # a code has how often products were bought together above the buyers of the second


class Near:
    """What products are near others, written once. Of the products in ``items`` (product_id, buyers, mass, listed) the listed
    ones have lists in ``lists`` (product_id, first, ids, codes); the others are reached by the baskets of their buyers, in
    ``held`` (who, nobody, piece, first, ids, codes), whom ``rows`` has by product. ``first`` marks the block scored first,
    ``mass`` is the most products that can be near."""

    def __init__(self, history: DataFrame, products: DataFrame, edges: DataFrame | None, size: int, blocks: int) -> None:
        self.blocks, self.given = blocks, edges is not None
        self.size_first = products.where(self.is_first("product_id")).count()
        known = products.select("product_id").distinct()
        piece = lambda c, n: F.pmod(F.xxhash64(c, F.lit(4)), n).cast("int").alias("piece")
        if edges is not None:
            for end in ("i", "j"):
                edges = edges.join(known.withColumnRenamed("product_id", end), end, "left_semi")
            edges = from_both_ends(edges.select("i", "j", fixed_point(F.col("sim"), 1 << EDGE_BITS).alias("code")), "code")
            pairs = edges.select(F.col("i").alias("product_id"), "j", "code", piece("j", F.lit(-(-size // PIECE))))
            self.lists = materialize(self._lists(pairs), "near-lists")
            mass = self.lists.groupBy("product_id").agg(F.sum(F.size("ids")).alias("mass"))
            self.items = materialize(mass.select("product_id", F.lit(1).cast("bigint").alias("buyers"), "mass", F.lit(True).alias("listed")), "near-items")
            return
        rows = materialize(bought_by(history.join(known, "product_id", "left_semi")), "bought-by")
        sizes = rows.groupBy("who", "nobody").agg(F.count(F.lit(1)).alias("size"))
        mass = rows.join(sizes, ["who", "nobody"]).groupBy("product_id").agg(F.max("buyers").alias("buyers"), F.sum("size").alias("mass"))
        self.items = materialize(mass.withColumn("listed", F.col("mass") > min(MANY, size // FEW)), "near-items")
        self.rows = materialize(rows.join(self.items.select("product_id", "listed"), "product_id"), "bought-rows")
        held = baskets(self.rows.withColumn("first", self.is_first("product_id")), "first")
        code = F.transform("buyers", lambda b: b + F.lit(1 << TIMES_AT))
        self.held = materialize(held.select("who", "nobody", "piece", "first", "ids", code.alias("codes")), "held")
        met = self.rows.where("listed").select("who", "nobody", F.col("product_id").alias("i")).join(
            baskets(self.rows), ["who", "nobody"])
        pairs = met.select("i", F.posexplode("ids").alias("at", "j"), "buyers").where("i <> j") \
            .groupBy("i", "j", F.get("buyers", F.col("at")).alias("n_j")).agg(F.count(F.lit(1)).alias("times"))
        pairs = pairs.join(self.items.select(F.col("product_id").alias("i"), F.least("mass", F.lit(size)).alias("most")), "i")
        self.lists = materialize(self._lists(pairs.select(
            F.col("i").alias("product_id"), "j", (F.shiftleft(F.col("times"), TIMES_AT) + F.col("n_j")).alias("code"),
            piece("j", F.ceil(F.col("most") / F.lit(PIECE)).cast("int")))), "near-lists")

    def is_first(self, product: str) -> Column:
        return F.pmod(F.xxhash64(product, F.lit(5)), F.lit(self.blocks)) == 0

    def _lists(self, pairs: DataFrame) -> DataFrame:
        found = pairs.groupBy("product_id", "piece", self.is_first("j").alias("first")).agg(
            F.collect_list(F.struct("j", "code")).alias("near"))
        return found.select("product_id", "first", F.col("near.j").alias("ids"), F.col("near.code").alias("codes"))


class _Shards:
    """The lists that score the clients of ``history``."""

    def __init__(self, history: DataFrame, near: Near, shards: int, asked: DataFrame | None = None) -> None:
        self.near, self.shards = near, shards
        own = history.where("client_id is not null").join(near.items, "product_id")
        client = lambda upper, lower: F.struct("client_id", upper.cast("bigint").alias("upper"), lower.cast("bigint").alias("lower"))
        shard = F.pmod(F.xxhash64("client_id", F.lit(2)), F.lit(shards)).cast("int").alias("shard")
        root = fixed_point(ratio(dbl(1), F.sqrt(F.col("buyers").cast("double"))), 1 << EDGE_BITS)
        if near.given:
            weight = F.col("n"), F.lit(0)
        else:
            weight = F.col("n") * F.shiftright(root, HALF), F.col("n") * root.bitwiseAND(F.lit((1 << HALF) - 1))
        listed = own.where("listed").groupBy("product_id", shard).agg(F.collect_list(client(*weight)).alias("clients"))
        self.listed = materialize(listed, "shard-lists")
        self.alike = None
        if not near.given:
            # weighed once per client met, however much they share
            met = own.where("not listed").select("client_id", "product_id", "n", "buyers").join(
                near.rows.where("not listed").select("who", "nobody", "product_id"), "product_id") \
                .where("nobody or who <> client_id").repartition("who", "nobody") \
                .groupBy("who", "nobody", "client_id").agg(F.sum(weight[0]).alias("upper"), F.sum(weight[1]).alias("lower"))
            alike = met.groupBy("who", "nobody", shard).agg(F.collect_list(client(F.col("upper"), F.col("lower"))).alias("clients"))
            self.alike = materialize(alike, "alike")
        marks = []
        for pairs, sign in ((history.where("client_id is not null"), BOUGHT), (asked, WANTED)):
            if pairs is not None:
                marks.append(pairs.groupBy("client_id", shard, near.is_first("product_id").alias("first")).agg(F.collect_list("product_id").alias("ids"))
                             .select("shard", F.array(client(F.lit(0), F.lit(0))).alias("clients"), "first", "ids",
                                     F.array_repeat(F.lit(sign).cast("bigint"), F.size("ids")).alias("codes")))
        self.marks = marks

    def cells(self, which: str) -> DataFrame:
        """(client_id, product_id, cf, asked) of unbought products in the block scored first, or in the others."""
        near, columns = self.near, ["shard", "clients", "ids", "codes"]
        met = self.listed.join(near.lists.where(which), "product_id").select(*columns)
        if self.alike is not None:
            met = met.unionByName(self.alike.join(near.held.where(which), ["who", "nobody"]).select(*columns))
        for marks in self.marks:
            met = met.unionByName(marks.where(which).select(*columns))
        # several times as many partitions as shards keep two of them from sharing a task
        sums = met.repartition(8 * self.shards, "shard").select("shard", F.inline("clients"), "ids", "codes") \
            .select("shard", "client_id", "upper", "lower", F.posexplode("ids").alias("at", "product_id"), "codes") \
            .select("shard", "client_id", "upper", "lower", "product_id", F.get("codes", F.col("at")).alias("code"))
        code = F.col("code")
        mark = F.when(code == BOUGHT, F.lit(HAD)).when(code == WANTED, F.lit(ASKED))
        if near.given:
            upper, lower = F.col("upper") * F.shiftright(code, HALF), F.col("upper") * code.bitwiseAND(F.lit((1 << HALF) - 1))
            info = F.coalesce(mark, F.lit(1).cast("bigint"))
        else:
            upper, lower = F.col("upper") * F.shiftright(code, TIMES_AT), F.col("lower") * F.shiftright(code, TIMES_AT)
            info = F.coalesce(mark, code.bitwiseAND(F.lit((1 << TIMES_AT) - 1)))
        cells = sums.groupBy("client_id", "shard", "product_id").agg(
            F.sum(upper).alias("upper"), F.sum(lower).alias("lower"), F.bit_or(info).alias("info"))
        # a product that is only asked for has no buyers here
        buyers = F.greatest(F.col("info").bitwiseAND(F.lit(ASKED - 1)), F.lit(1)).cast("double")
        return cells.where(F.col("info") < HAD).select(
            "client_id", "product_id", (_whole() / F.sqrt(buyers)).alias("cf"), (F.col("info") >= ASKED).alias("asked"))


def _placed(cells: DataFrame, depth: int) -> DataFrame:
    best = W.partitionBy("client_id").orderBy(F.desc("cf"), "product_id")
    return cells.withColumn("place", F.row_number().over(best)).where((F.col("place") <= depth) | F.col("asked"))


def collaborative_scores(history: DataFrame, near: Near, depth: int, shards: int, asked: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(client_id, product_id, cf, place): unbought products by their similarity to the history, the best ``depth`` of every
    client and those in ``asked``; and (client_id, some): how many products have a score in the block scored first."""
    lists = _Shards(history, near, shards, asked)
    scored = F.count(F.when(F.col("cf") > 0, True)).over(W.partitionBy("client_id")).alias("some")
    with settings(history.sparkSession, ONE_MAP):
        first = materialize(_placed(lists.cells("first").select("*", scored), depth), "first-block")
    some = first.where("place = 1").select("client_id", "some")
    first = first.drop("some")
    bars = first.where(F.col("place") == depth).select("client_id", F.col("cf").alias("bar"))
    # a row per client of the batch
    rest = lists.cells("not first").join(F.broadcast(bars), "client_id", "left").where(
        F.col("asked") | (F.col("cf") >= F.coalesce("bar", dbl(0)))).drop("bar")
    with settings(history.sparkSession, ONE_MAP):
        return materialize(_placed(first.drop("place").unionByName(rest), depth).drop("asked"), "collaborative"), some


def scored_products(history: DataFrame, near: Near, free: DataFrame, some: DataFrame, shards: int) -> DataFrame:
    """(client_id, known, least): how many unbought products have a score and the smallest, of clients that may have one for
    each: there are as many entries in their lists, and in the block scored first (``some``) none is without."""
    entries = history.join(near.items, "product_id", "left").groupBy("client_id").agg(
        F.coalesce(F.sum("mass"), F.lit(0)).alias("mass"), F.count(F.when(near.is_first("product_id"), True)).alias("bought"))
    many = entries.join(free, "client_id").join(some, "client_id", "left").where(
        (F.col("mass") >= F.col("free")) & (F.coalesce("some", F.lit(0)) + F.col("bought") >= near.size_first))
    many = materialize(many.select("client_id"), "many-scores")
    if many.isEmpty():
        return many.select("client_id", F.lit(0).cast("bigint").alias("known"), dbl(0).alias("least"))
    lists = _Shards(history.join(many, "client_id", "left_semi"), near, shards)
    scored = lists.cells("first").unionByName(lists.cells("not first")).where("cf > 0")
    return scored.groupBy("client_id").agg(F.count(F.lit(1)).alias("known"), F.min("cf").alias("least"))


# --- lists --------------------------------------------------------------------------------------------


def _filled(listed: DataFrame, open_clients: DataFrame, history: DataFrame, products: DataFrame, k: int) -> DataFrame:
    """Collaborative lists, made up to ``k`` by the first unbought products without a score, in the order of ids."""
    some = listed.groupBy("client_id").agg(F.count(F.lit(1)).alias("n"))
    short = open_clients.join(some, "client_id", "left").where(F.coalesce("n", F.lit(0)) < k).select("client_id")
    short = materialize(short, "short-lists")
    if short.isEmpty():
        return listed
    ids = products.select("product_id", F.lit(1).alias("one"))
    ranked = materialize(with_running_sums(ids, ["product_id"], {"rank": "one"}).select("rank", "product_id"), "id-order")
    taken = history.select("client_id", "product_id").unionByName(listed.select("client_id", "product_id")) \
        .join(short, "client_id", "left_semi")
    rest = popular_recs(taken, ranked, k).select("client_id", "product_id", dbl(0).alias("cf"))
    return listed.unionByName(rest)


def _listed(scores: DataFrame, model: str, k: int) -> DataFrame:
    """The best ``k`` of (client_id, product_id, score), by rounded score and id."""
    best = W.partitionBy("client_id").orderBy(F.desc("score"), "product_id")
    return scores.withColumn("score", F.round("score", 9)).withColumn("rank", F.row_number().over(best)) \
        .where(F.col("rank") <= k).select("client_id", F.lit(model).alias("model"), "rank", "product_id", "score")


def recommend(history: DataFrame, products: DataFrame, k: int = 5,
              models: dict[str, float] | None = None, edges: DataFrame | None = None,
              wanted: DataFrame | None = None, blocks: int | None = None,
              shards: int | None = None, depth: int | None = None) -> DataFrame:
    """Top ``k`` unbought products per client and model: (client_id, model, rank, product_id, score).

    ``models`` maps a name to the weight of the collaborative score, the rest being the content score; both are min-max
    scaled over all unbought products of the client. ``edges`` (i < j) are the similarities of the whole purchase history
    unless given, ``wanted`` narrows the clients scored. Products outside the catalogue neither count nor come back.
    """
    checked_k(k)
    models = models or {"hybrid": MODELS["hybrid"]}
    spark = products.sparkSession
    history = materialize(history, "history")
    scored = history.join(wanted.select("client_id").distinct(), "client_id", "left_semi") if wanted is not None else history
    scored = materialize(scored.join(products.select("product_id"), "product_id", "left_semi").select("client_id", "product_id", "n"), "scored")
    size = products.count()
    near = shop = None
    if any(a != 0 for a in models.values()):
        near = Near(history, products, edges, size, blocks or max(1, min(BLOCKS, size // BLOCK_PRODUCTS)))
    if any(a != 1 for a in models.values()):
        shop = Catalogue(products)
    free = scored.groupBy("client_id").agg((F.lit(size) - F.count(F.lit(1))).alias("free")).where("free > 0")
    free = materialize(free, "free")
    tasks, batches = _grid(scored, free, near, shop, size, spark.sparkContext.defaultParallelism)
    task = _Task(products, size, shop, near, shards or math.ceil(tasks / batches), k)

    def answers(own: DataFrame, open_clients: DataFrame) -> DataFrame:
        profile = materialize(_profile(own, shop.products), "profile") if shop else None
        return _recommend(task, own, profile, open_clients, models, depth or DEPTH)

    if batches == 1:
        return answers(scored, free)
    batch = lambda df, b: df.where(F.pmod(F.xxhash64("client_id", F.lit(3)), F.lit(batches)) == b)
    found = [settled(spark, lambda b=b: answers(materialize(batch(scored, b), "scored"), materialize(batch(free, b), "free")), "answers")
             for b in range(batches)]
    every = found[0]
    for rows in found[1:]:
        every = every.unionByName(rows)
    return every


def _grid(scored: DataFrame, free: DataFrame, near: Near | None, shop: Catalogue | None, size: int, parallelism: int) -> tuple[int, int]:
    """Shards that bound the scores in a task, and batches that bound what is sent on the way."""
    n, least, tasks = scored.count(), max(1, BATCH_LEAST), 3 * parallelism
    batches = 1
    if near:
        mass = scored.join(near.items, "product_id").groupBy("client_id").agg(F.sum("mass").cast("double").alias("mass"))
        # as many different products as so many draws give
        some = F.sum(dbl(size) * (dbl(1) - F.exp(-F.col("mass") / dbl(size))))
        cells, entries = mass.agg(F.coalesce(some, dbl(0)), F.coalesce(F.sum("mass"), dbl(0))).first()
        tasks = max(tasks, math.ceil(cells / CELLS))
        batches = max(batches, math.ceil(min(entries, float(tasks) * n) / max(least, SENT * n)))
    if shop:
        batches = max(batches, math.ceil(free.count() * shop.bands.count() / max(least, BANDS * n)))
    return tasks, batches


@dataclass
class _Task:
    """What all rounds share."""

    products: DataFrame
    size: int
    shop: Catalogue | None
    near: Near | None
    shards: int
    k: int


def _recommend(task: _Task, scored: DataFrame, profile: DataFrame | None, free: DataFrame, models: dict[str, float], depth: int) -> DataFrame:
    k, shop = task.k, task.shop
    mixed = {name: a for name, a in models.items() if a not in (0, 1)}
    use_collab, use_content = any(a != 0 for a in models.values()), any(a != 1 for a in models.values())
    depth = max(k, depth) if mixed else k
    clients = free.select("client_id")
    out, listed = [], None
    if use_content:
        content = materialize(content_scores(scored, profile, shop, depth), "content")
        best = W.partitionBy("client_id").orderBy(F.desc("ct"), "product_id")
        listed = content.withColumn("place", F.row_number().over(best)).where(F.col("place") <= depth)
        listed = materialize(listed, "content-lists") if mixed else listed
        ct_range = content.groupBy("client_id").agg(F.min("ct").alias("ct_lo"), F.max("ct").alias("ct_hi"))
        ct_range = materialize(ct_range, "content-ranges")
        scores = listed.where(F.col("place") <= k).join(ct_range, "client_id").select(
            "client_id", "product_id", _min_max("ct", "ct_lo", "ct_hi").alias("score"))
        out += [_listed(scores, name, k) for name, a in models.items() if a == 0]
    if use_collab:
        cells, some = collaborative_scores(scored, task.near, depth, task.shards, listed.select("client_id", "product_id") if mixed else None)
        firsts = cells.where("place = 1").select("client_id", F.col("cf").alias("cf_hi"))
        # the smallest score is 0 unless every unbought product has one
        low = F.when(F.col("known") >= F.col("free"), F.col("least")).otherwise(dbl(0))
        cf_range = free.join(firsts, "client_id", "left").join(scored_products(scored, task.near, free, some, task.shards), "client_id", "left")
        cf_range = materialize(cf_range.select(
            "client_id", F.coalesce(low, dbl(0)).alias("cf_lo"), F.coalesce("cf_hi", dbl(0)).alias("cf_hi")), "collaborative-ranges")
        best = W.partitionBy("client_id").orderBy(F.desc("cf"), "product_id")
        known = cells.where("cf > 0").withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= k) \
            .select("client_id", "product_id", "cf")
        if any(a == 1 for a in models.values()):
            scores = _filled(materialize(known, "collaborative-lists"), clients, scored, task.products, k) \
                .join(cf_range, "client_id").select("client_id", "product_id", _min_max("cf", "cf_lo", "cf_hi").alias("score"))
            out += [_listed(scores, name, k) for name, a in models.items() if a == 1]
    if mixed:
        both = with_content(cells.select("client_id", "product_id", "cf"), profile, shop).join(cf_range, "client_id").join(ct_range, "client_id")
        both = materialize(both.select("client_id", "product_id", _min_max("cf", "cf_lo", "cf_hi").alias("x"),
                                       _min_max("ct", "ct_lo", "ct_hi").alias("y")), "both-scores")
        # what is in neither list has at most the last score of each; a list that ends early holds all there is
        cut = cells.where((F.col("place") == depth) & (F.col("cf") > 0)).select("client_id", F.col("cf").alias("cf_at"))
        end = listed.where(F.col("place") == depth).select("client_id", F.col("ct").alias("ct_at"))
        bound = cut.join(end, "client_id").join(cf_range, "client_id").join(ct_range, "client_id").select(
            "client_id", _min_max("cf_at", "cf_lo", "cf_hi").alias("x_at"), _min_max("ct_at", "ct_lo", "ct_hi").alias("y_at"))
        bound = materialize(bound, "bounds")
        for name, a in mixed.items():
            mix = lambda x, y, a=a: dbl(a) * F.col(x) + dbl(1 - a) * F.col(y)
            answers = materialize(_listed(both.select("client_id", "product_id", mix("x", "y").alias("score")), name, k), "hybrid-lists")
            last = answers.where(F.col("rank") == k).select("client_id", F.col("score").alias("reached"))
            late = bound.join(last, "client_id", "left").where(
                F.col("reached").isNull() | (mix("x_at", "y_at") + dbl(1e-9) >= F.col("reached"))).select("client_id")
            late = materialize(late, "unsettled")
            if depth >= task.size or late.isEmpty():
                out.append(answers)
                continue
            out.append(answers.join(late, "client_id", "left_anti"))
            only = lambda df, late=late: df.join(late, "client_id", "left_semi")
            out.append(_recommend(task, materialize(only(scored), "scored"), materialize(only(profile), "profile"),
                                  materialize(only(free), "free"), {name: a}, 8 * depth))
    found = out[0]
    for rows in out[1:]:
        found = found.unionByName(rows)
    return found


def with_names(answers: DataFrame, products: DataFrame, of: str = "product_id") -> DataFrame:
    """Answers with the name and category of the product that column ``of`` tells."""
    names = products.select(F.col("product_id").alias("_of"), "name", "category")
    return answers.join(names, F.col(of) == F.col("_of"), "left").drop("_of")


def recommend_or_popular(clients: DataFrame, sales: DataFrame | None, products: DataFrame, k: int = 5,
                         history: DataFrame | None = None, edges: DataFrame | None = None) -> DataFrame:
    """Hybrid recommendations for known clients, best sellers for clients without a purchase. ``history`` and ``edges``
    are learned from ``sales`` unless given, as when they were published before."""
    checked_k(k)
    history = materialize(purchase_history(sales), "history") if history is None else history
    asked = clients.select("client_id").distinct()
    sizes = history.groupBy("client_id").agg(F.sum("n").alias("n_known"))
    personal = recommend(history, products, k, edges=edges, wanted=asked) \
        .join(sizes, "client_id").select("client_id", F.lit("hybrid").alias("source"), "n_known", "rank", "product_id")
    top = popularity_list(history, products.sparkSession, k)
    cold = asked.join(sizes, "client_id", "left_anti") \
        .select("client_id", F.lit("popular").alias("source"), F.lit(0).cast("bigint").alias("n_known"),
                F.posexplode(top).alias("pos", "product_id")) \
        .select("client_id", "source", "n_known", (F.col("pos") + 1).alias("rank"), "product_id")
    return personal.unionByName(cold)


def popularity_list(history: DataFrame, spark, k: int):
    """The ``k`` best sellers as one array, in order."""
    best = history.groupBy("product_id").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "product_id").limit(k)
    pairs = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "product_id")))
    return best.agg(F.transform(pairs, lambda s: s["product_id"]).alias("top")).scalar()


def evaluate(sales: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    """Recall and precision at ``k`` on the held-out last purchases, in percent.

    A held-out product the client had bought before can not be recommended and
    counts as a miss.
    """
    checked_k(k)
    sales = materialize(sales.select("client_id", "product_id", "sale_date", "sale_id"), "eval-sales")
    train, test = leave_last_out(sales)
    history = materialize(purchase_history(train), "train-history")
    test = materialize(test, "held-out")
    personal = recommend(history, products, k, models=MODELS, wanted=test) \
        .select("client_id", "model", "product_id")
    ranked = materialize(popularity(train), "popularity")
    popular = popular_recs(history, ranked, k).select("client_id", F.lit("popular").alias("model"), "product_id")
    hits = personal.unionByName(popular).join(test, ["client_id", "product_id"], "left_semi") \
        .groupBy("model").agg(F.count(F.lit(1)).alias("hits"))
    evaluated = test.agg(F.count(F.lit(1)).alias("n")).scalar()
    names = F.explode(F.array(*[F.lit(m) for m in ("popular", "content", "collaborative", "hybrid")]))
    models = products.sparkSession.range(1).select(names.alias("model"))
    recall = F.try_divide(F.coalesce("hits", F.lit(0)).cast("double"), evaluated.cast("double"))
    rows = models.join(hits, "model", "left").select("model", recall.alias("recall"))
    chance = products.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("random").alias("model"), F.try_divide(F.lit(k).cast("double"), F.col("n").cast("double")).alias("recall"))
    hundred = F.lit(100.0).cast("double")
    return rows.unionByName(chance).select(
        "model", F.bround(F.col("recall") * hundred, 1).alias("recall_pct"),
        F.bround(F.col("recall") / F.lit(k).cast("double") * hundred, 1).alias("precision_pct"))
