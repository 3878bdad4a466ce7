"""Near duplicates by a grouped prefix join on five-word shingles, at a Jaccard similarity of 0.75 or more.

A document is the set of its distinct shingles (see ``words``). Shingles have one order for all: rare ones first, by
hash, then the HEAVY most common ones by count. Counts come from the whole corpus: every task counts its shingles and
reports those it has twice or more. The order decides only how many candidates there are, never the result.

1. Prefixes. Two sets that are similar enough share a shingle among the first n - ceil(3n/4) + 1 of each. Documents with
   the same prefix and size are one group and send their prefix once per task.
2. Group pairs. A shingle that only one group has is dropped at once, in the shuffle that brings equal shingles together.
3. Members. Equal sets are one class. First each group is compared with one other, the hub that most of its shingles
   name: the group in whose prefix the shingle stands first, which has the fewest shingles of its own. In a crowd of near
   copies that is the text they were made from, so one check per member ties the crowd together. Then all pairs that
   share prefix shingles, pass the length filter, the positional filter and the overlap filter and are not tied already
   are listed once, where a run of shared shingles begins, and checked on the whole texts. A pair left out is already joined by checked links, so
   the components are those of all links.
4. Components are found by rounds of joins; every class takes its component, every document its class.

Positional filter: in the prefix of x a shingle stands behind the shared ones before it (no other can be in y) and before
the rest of x, so with any set that has it too x shares at most their number and the rest. At the first shingle that two
sets share, both must have as many shingles left as they must share; this keeps a text a little too far from the common
ones of a crowd, whose prefix begins with shingles of its own, from meeting the whole crowd. Overlap filter: let the
prefix of x end before that of y in the common order. What they share lies in both prefixes, where it was counted, or
behind the prefix of x; so they share at most the count and what x has behind its prefix.

Defined results: null and empty texts, and texts without words, have no shingles and stay alone, as their own component.
One to four words are one shingle. Rows that share a doc_id count as one document with all their links. A row without
doc_id gets the component of the documents with an equal set, otherwise null, and links nothing. An empty table gives
an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.storage import stored
from tradewind.llm.components import components
from tradewind.llm.lookup import only_wanted, without
from tradewind.llm.words import shingle_sets, small

#: The common shingles that the order puts last, at most (a broadcast of 8 bytes each).
HEAVY = 1 << 16
#: Shingles a task counts at a time.
COUNTED = 1 << 21


def prefix_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1 if n else 0


def _key(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


_CENSUS = "doc_id bigint, n bigint, key binary, token bigint, times bigint"


def _census(batches):
    """A row per document with the size and the hash of its set, and the shingles that many documents here share."""
    held, filled = [], 0

    def common():
        tokens, times = np.unique(np.concatenate(held), return_counts=True)
        some = times > 1
        k = int(some.sum())
        none = pa.nulls(k)
        return pa.RecordBatch.from_arrays(
            [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()), pa.array(tokens[some].view(np.int64)),
             pa.array(times[some].astype(np.int64))], names=["doc_id", "n", "key", "token", "times"])

    for batch in small(batches):
        sizes, keys = [], []
        for own in shingle_sets(batch.column("text")):
            sizes.append(len(own))
            keys.append(_key(own) if len(own) else None)
            held.append(own)
            filled += len(own)
            if filled >= COUNTED:
                yield common()
                held, filled = [], 0
        none = pa.nulls(len(sizes)).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                                          none, none], names=["doc_id", "n", "key", "token", "times"])
    if filled:
        yield common()


_PREFIX = "token bigint, g bigint, n int, pos int, key binary"


def _prefixes(common: np.ndarray, rank: np.ndarray):
    """Rows (shingle, group, size, place) of the prefixes, and for each set one row (end of the prefix in the order of
    shingles, group, size, -1, key)."""
    def run(batches):
        seen: set[bytes] = set()
        for batch in small(batches):
            tokens, groups, sizes, places, keys = [], [], [], [], []

            def flush():
                out = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (tokens, groups, sizes, places)]
                if not len(out[0]):
                    return None
                return pa.RecordBatch.from_arrays(
                    [pa.array(out[0]), pa.array(out[1]), pa.array(out[2].astype(np.int32)), pa.array(out[3].astype(np.int32)),
                     pa.array(keys, pa.binary())], names=["token", "g", "n", "pos", "key"])

            for own in shingle_sets(batch.column("text")):
                if not len(own):
                    continue
                key = _key(own)
                if key in seen:
                    continue
                seen.add(key)
                k = prefix_length(len(own))
                if len(common):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    heavy = common[at] == own
                    first = own[~heavy][:k]
                    ranks = np.sort(rank[at[heavy]])[:k - len(first)]
                    last = (1 << 62) + int(ranks[-1]) if len(ranks) else int(first[-1] >> np.uint64(2))
                    if len(ranks):
                        first = np.concatenate([first, own[heavy][np.argsort(rank[at[heavy]], kind="stable")][:len(ranks)]])
                else:
                    first, last = own[:k], int(own[k - 1] >> np.uint64(2))
                g = int.from_bytes(hashlib.blake2b(first.tobytes(), digest_size=8, salt=len(own).to_bytes(8, "big")).digest(),
                                   "big", signed=True)
                tokens.append(np.append(first.view(np.int64), last))
                groups.append(np.full(k + 1, g, np.int64))
                sizes.append(np.full(k + 1, len(own), np.int64))
                places.append(np.append(np.arange(k), -1))
                keys.extend([None] * k + [key])
                if len(keys) > 200_000:
                    yield flush()
                    tokens, groups, sizes, places, keys = [], [], [], [], []
            rest = flush()
            if rest is not None:
                yield rest
    return run


def _keyed(batches):
    """The hash of the set beside each text."""
    for batch in small(batches):
        keys = [_key(s) if len(s) else None for s in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column("text")], names=["key", "text"])


def _similar(batches):
    for batch in small(batches):
        good = []
        for x, y in zip(shingle_sets(batch.column("x")), shingle_sets(batch.column("y")), strict=True):
            both = np.concatenate([x, y])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            good.append(100 * shared >= 75 * (len(both) - shared))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))


def _checked(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b) of ``pairs`` (a, ka, b, kb) whose sets are similar enough. Texts travel, not sets: compressed they are
    less than half as long as eight bytes for each word."""
    pairs = stored(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    texts = stored(only_wanted(docs, ids).select("text").mapInArrow(_keyed, "key binary, text string"), "texts")
    one = pairs.join(texts.select(F.col("key").alias("ka"), F.col("text").alias("x")), "ka")
    two = one.join(texts.select(F.col("key").alias("kb"), F.col("text").alias("y")), "kb")
    return two.select("a", "b", "x", "y").mapInArrow(_similar, "a bigint, b bigint")


def _enough(count: str, n: str, last: str, n2: str, last2: str):
    """The length and overlap filters for two sets of which ``count`` shingles of the prefixes are shared."""
    behind, behind2 = (F.floor((3 * F.col(c) + 3) / 4) - 1 for c in (n, n2))
    most = F.when(F.col(last) < F.col(last2), behind).when(F.col(last) > F.col(last2), behind2).otherwise(F.greatest(behind, behind2))
    return ((4 * F.least(n, n2) >= 3 * F.greatest(n, n2)) & (7 * (F.col(count) + most) >= 3 * (F.col(n) + F.col(n2))))


def _several(census: DataFrame) -> DataFrame:
    """The ids that rows of different sets share."""
    some = F.xxhash64("key")
    return census.where("key is not null and doc_id is not null").groupBy("doc_id").agg(
        F.min(some).alias("a"), F.max(some).alias("b")).where("a <> b").select("doc_id")


def _bridges(census: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of rows that share an id."""
    ids = _several(census).withColumnRenamed("doc_id", "_id")
    own = census.join(ids, F.col("doc_id") == F.col("_id")).where("key is not null").select("doc_id", "key").distinct().join(classes, "key")
    return own.groupBy("doc_id").agg(F.min("rep").alias("a")).join(own.select("doc_id", F.col("rep").alias("b")), "doc_id") \
        .where("a <> b").select("a", "b")


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    census = stored(docs.mapInArrow(_census, _CENSUS), "census")
    heavy = (census.where("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
             .orderBy(F.desc("times"), "token").limit(HEAVY).collect())  # at most HEAVY rows
    tokens = np.array([r["token"] for r in heavy], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    common = spark.sparkContext.broadcast((tokens[order], np.arange(len(tokens))[::-1][order]))  # rank: rarer first

    def prefixes(batches):
        yield from _prefixes(*common.value)(batches)

    each = Window.partitionBy("token")
    alike = Window.partitionBy("token", "kind")
    rows = docs.select("text").mapInArrow(prefixes, _PREFIX)
    rows = rows.withColumn("lo", F.min("g").over(each)).withColumn("hi", F.max("g").over(each)).where("pos < 0 or lo <> hi")
    kind = F.floor(F.log(F.col("n")) / F.log(F.lit(4 / 3)))  # sizes of one kind can be similar
    rows = rows.drop("lo", "hi").withColumn("kind", kind).withColumn("hub", F.min(F.struct("pos", "g")).over(alike)["g"]).drop("kind")
    shared = stored(rows.distinct(), "shared-shingles")

    classes = stored(census.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("rep")), "classes")
    members = shared.where("pos < 0").select("g", "n", "key", F.col("token").alias("last")).distinct().join(classes.where("rep is not null"), "key")
    members = stored(members, "members")
    groups = members.groupBy("g", "n", "last").agg(F.min(F.struct("rep", "key")).alias("first"), F.count("*").alias("many"))
    met = shared.where("pos >= 0").select(F.col("g").alias("met_g")).distinct()
    active = groups.join(met, F.col("g") == F.col("met_g"), "left").where("met_g is not null or many > 1")
    active = stored(active.select("g", "n", "last", F.col("first.rep").alias("lead"), F.col("first.key").alias("lead_key")), "groups")
    leads = active.select("g", "lead", "lead_key")
    nodes = stored(members.join(leads, "g"), "nodes")  # key, g, n, last, rep, lead, lead_key

    # one check per member: with the hub its group names most, if that can be, and with the first of its own group
    # all its shared shingles bound what a group can share with its hub, whichever of them name it
    named = shared.where("pos >= 0").groupBy("g", "hub").count()
    hubs = named.groupBy("g").agg(F.expr("max_by(hub, if(g <> hub, count, 0))").alias("hub"), F.sum("count").alias("shared"))
    hubs = hubs.where("g <> hub")
    of_hub = active.select(F.col("g").alias("hub"), F.col("n").alias("n2"), F.col("last").alias("last2"),
                           F.col("lead").alias("a"), F.col("lead_key").alias("ka"))
    near = nodes.join(hubs, "g").join(of_hub, "hub").where(_enough("shared", "n", "last", "n2", "last2")).select(
        "a", "ka", F.col("rep").alias("b"), F.col("key").alias("kb"))
    own = nodes.where("rep <> lead").select(F.col("lead").alias("a"), F.col("lead_key").alias("ka"),
                                            F.col("rep").alias("b"), F.col("key").alias("kb"))
    ties = stored(_checked(near.unionByName(own), docs), "ties")

    top = components(ties)
    marked = nodes.join(top, F.col("rep") == F.col("id"), "left").select(
        "g", "n", "last", "key", "rep", F.coalesce("label", "rep").alias("label"))
    marked = stored(marked, "marked")
    # what a set can share with one that has this shingle too: the shared shingles before it, and all from it on
    order = Window.partitionBy("g", "rep", "key").orderBy("pos")
    spread = shared.where("pos >= 0").select("token", "g", "pos").join(marked, "g")
    spread = spread.withColumn("most", F.row_number().over(order) - 1 + F.col("n") - F.col("pos"))
    spread = spread.withColumn("before", F.lag("token", 1).over(order)).withColumn("before2", F.lag("token", 2).over(order))
    spread = spread.withColumn("lo", F.min("label").over(each)).withColumn("hi", F.max("label").over(each))
    spread = stored(spread.where("lo <> hi").select(
        "token", "n", "last", "most", "pos", "before", "before2", "key", "rep", "label"), "open-shingles")
    p, q = spread.alias("p"), spread.alias("q")
    # from the first shingle they share on, both must have enough left; a pair that shares one of the two shingles before
    # was listed there
    rest = F.least(F.col("p.n") - F.col("p.pos"), F.col("q.n") - F.col("q.pos"))
    listed = F.lit(False)
    for x in ("p.before", "p.before2"):
        for y in ("q.before", "q.before2"):
            listed = listed | F.coalesce(F.col(x) == F.col(y), F.lit(False))
    apart = (F.col("p.rep") < F.col("q.rep")) & (F.col("p.label") != F.col("q.label"))
    shown = [F.col("p.rep").alias("a"), F.col("p.key").alias("ka"), F.col("q.rep").alias("b"), F.col("q.key").alias("kb")]
    both_n = F.col("p.n") + F.col("q.n")
    sizes = ((4 * F.least("p.n", "q.n") >= 3 * F.greatest("p.n", "q.n")) & (7 * F.least("p.most", "q.most") >= 3 * both_n)
             & (7 * rest >= 3 * both_n))
    both = p.join(q, (F.col("p.token") == F.col("q.token")) & apart & sizes & ~listed).select(
        *shown, *[F.col(f"p.{c}").alias(c) for c in ("n", "last")], *[F.col(f"q.{c}").alias(f"{c}2") for c in ("n", "last")])
    both = stored(both.distinct(), "candidates")
    # all shingles of the prefixes that a pair shares are open ones
    wanted = both.select(F.col("ka").alias("key")).unionByName(both.select(F.col("kb").alias("key"))).distinct()
    sets = stored(spread.join(wanted, "key", "left_semi").groupBy("key").agg(F.collect_list("token").alias("tokens")), "open-sets")
    both = both.join(sets.select(F.col("key").alias("ka"), F.col("tokens").alias("x")), "ka")
    both = both.join(sets.select(F.col("key").alias("kb"), F.col("tokens").alias("y")), "kb")
    across = both.withColumn("shared", F.size(F.array_intersect("x", "y"))).where(_enough("shared", "n", "last", "n2", "last2"))
    across = across.select("a", "ka", "b", "kb")
    s, t = marked.alias("p"), marked.alias("q")
    within = s.join(t, (F.col("p.g") == F.col("q.g")) & apart).select(*shown)
    more = _checked(across.unionByName(within).distinct(), docs)
    joined = components(ties.unionByName(more).unionByName(stored(_bridges(census, classes), "bridges")))
    of_class = classes.join(joined, F.col("rep") == F.col("id"), "left").select(
        F.col("key").alias("_key"), F.coalesce("label", "rep").alias("component_id"))
    out = census.where("token is null").join(of_class, F.col("key") == F.col("_key"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the one whose id names it. All columns stay as they are. Rows
    without an id stay, and rows whose id has several different texts, so that no text goes with another's."""
    found = stored(find(docs), "near-duplicates")
    lost = found.where("doc_id <> component_id").select("doc_id")
    typed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    repeated = stored(found.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"), "repeated-ids")
    several = _several(only_wanted(typed, repeated).mapInArrow(_census, _CENSUS).where("token is null"))
    return without(docs, stored(lost.join(several, "doc_id", "left_anti"), "near-copies"))
