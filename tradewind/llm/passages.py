r"""Removal of passages that repeat: every byte under a string of LENGTH bytes that also starts elsewhere.

One index of a large corpus fits no task, so equal strings are first brought together, then indexed in buckets.

1. Anchors. Of the GRAM-byte strings in a window of LENGTH bytes the one of the smallest hash, then the leftmost, is the
   window's anchor. Equal windows have equal anchors at equal places, so all windows of an anchor lie in the piece around
   it. About one byte in 60 is an anchor. An anchor has the hash of its gram and the hash of its piece.
2. Pieces. Anchors are counted by both hashes, combined before the shuffle; only grams that occur twice are looked at (a
   2 MB bitmap keeps the others out). A piece that occurs twice as a whole is settled: every copy goes. A gram with one
   piece needs nothing more. What is left are the borders of passages: grams with different pieces, one example of each.
3. Index. A gram has a bucket; pieces of one text and bucket that overlap become one region, so no byte is in a bucket
   twice. A task builds the run-length index of its bucket (``rindex``), streams the matching statistics and marks what
   matches LENGTH bytes or more anywhere else in the bucket.
4. A gram with more than HOT different pieces would outgrow a bucket. The windows of its pieces are then the unit, as pieces
   of LENGTH bytes without a border: those that occur twice go.
5. Marks meet their texts; only texts with marks are shuffled.

Texts are judged as they came in, so marks do not depend on each other. Equality of pieces and windows is that of 128 bits of
hash; in the index it is that of bytes.

Defined results: null is the empty text. Texts shorter than LENGTH lose nothing. Rows that share doc_id and text are two rows
that repeat each other; rows without an id are rows like others. A removed run may end within a character, so what is kept is
bytes. An empty table gives an empty result. Columns other than doc_id and text are neither read nor changed.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.storage import stored
from tradewind.llm import rindex
from tradewind.llm.lookup import only_wanted, without

LENGTH = 200
HOT = 4096                  # different pieces of one gram that share a bucket at most (1.3 MB of them)
BUCKET = 3 << 19            # about as many bytes in a bucket
SLICE = 1 << 20             # bytes hashed at a time
HOT_SHARE = 1000            # a piece is hot when more than one anchor in so many has it
SALTED_ROWS = 4096          # about as many anchors of a hot piece under one key

_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(pow(base, done, 2**64))
        done += more
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Hasher:
    """Polynomial hashes of substrings from prefix sums, modulo 2^64, over random values for bytes."""

    def __init__(self) -> None:
        values = np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=8).digest() for b in range(256)), np.uint64)
        self.values, self.size = values, 0

    def _grow(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, 2 * self.size, 1 << 16)
            self.up, self.down = _powers(_BASE, self.size), _powers(pow(_BASE, -1, 2**64), self.size)

    def sums(self, text: np.ndarray) -> np.ndarray:
        self._grow(len(text) + 1)
        out = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(self.values[text] * self.up[:len(text)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((sums[end] - sums[start]) * self.down[start])

    def every(self, sums: np.ndarray, length: int) -> np.ndarray:
        n = len(sums) - length
        return _mixed((sums[length:] - sums[:-length]) * self.down[:n])


def gram_of(length: int) -> int:
    return max(1, 2 * length // 5)


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from the running minima of blocks in both directions."""
    full = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:len(keys)] = keys
    blocks = full.reshape(-1, width)
    forth = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keys) - width + 1
    return np.minimum(back[:n], forth[width - 1:width - 1 + n])


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _slices(texts: list[bytes], length: int):
    """Groups of slices (text, offset, first, last, bytes) of about SLICE bytes: anchors between first and last are told by
    their slice alone, which has what reaches to both sides."""
    reach = length - gram_of(length)
    held, size = [], 0
    for k, text in enumerate(texts):
        if len(text) < length:
            continue
        for a in range(0, len(text), SLICE):
            b = min(a + SLICE, len(text))
            lo = max(0, a - reach)
            held.append((k, lo, a, b, text[lo:b + length]))
            size += len(held[-1][4])
            if size >= SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def anchors_of(slices: list, length: int, hasher: Hasher) -> tuple[np.ndarray, ...]:
    """(text, place, hash of the gram, hash of the piece) of the anchors in slices."""
    gram = gram_of(length)
    reach = length - gram
    text = np.frombuffer(b"".join(s[4] for s in slices), np.uint8)
    if len(text) < length:  # the last bytes of a text: their windows belong to the slice before
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    sizes = np.array([len(s[4]) for s in slices], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    owner = np.repeat(np.arange(len(slices)), sizes)
    sums = hasher.sums(text)
    grams = hasher.every(sums, gram)
    # 32 bits of hash, then the place: the smallest is the leftmost of the smallest hashes
    keys = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(keys, reach + 1)
    whole = owner[:len(least)] == owner[length - 1:length - 1 + len(least)]
    chosen = np.zeros(len(text), bool)
    chosen[(least[whole] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
    at = np.flatnonzero(chosen)
    who = owner[at]
    offset, first, last = (np.array([s[i] for s in slices], np.int64) for i in (1, 2, 3))
    place = at - starts[who] + offset[who]
    own = (place >= first[who]) & (place < last[who])
    at, who, place = at[own], who[own], place[own]
    s, e = np.maximum(at - reach, starts[who]), np.minimum(at + length, ends[who])
    shape = ((at - s).astype(np.uint64) << np.uint64(32)) | (e - at).astype(np.uint64)
    piece = _mixed(hasher.of(sums, s, e) ^ (shape * np.uint64(_BASE)))
    return np.array([s[0] for s in slices], np.int64)[who], place, grams[at], piece


_ANCHOR = "row binary, pos bigint, h bigint, d bigint"


def _anchors(length: int):
    def run(batches):
        hasher = Hasher()
        for batch in batches:
            rows = batch.column("row")
            for slices in _slices(_texts(batch.column("text")), length):
                text, place, h, d = anchors_of(slices, length, hasher)
                yield pa.RecordBatch.from_arrays(
                    [rows.take(pa.array(text)), pa.array(place), pa.array(h.view(np.int64)), pa.array(d.view(np.int64))],
                    names=["row", "pos", "h", "d"])
    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


_REGION = "bucket int, row binary, start bigint, body binary, h bigint, w bigint"
#: Bytes of regions, and number of windows, sent on at a time.
STEP = 1 << 22


def _regions(length: int):
    """Texts with the places of their pieces to regions for buckets, and to windows of hot grams."""
    reach = length - gram_of(length)
    names = ["bucket", "row", "start", "body", "h", "w"]

    def bodies(held):
        none = pa.nulls(len(held), pa.int64())
        columns = [pa.array(c, t) for c, t in zip(zip(*held), (pa.int32(), pa.binary(), pa.int64(), pa.binary()))]
        return pa.RecordBatch.from_arrays([*columns, none, none], names=names)

    def run(batches):
        hasher, held, size = Hasher(), [], 0
        for batch in batches:
            found = batch.column("found")
            places, keys, hots = (found.flatten().field(i).to_pylist() for i in range(3))
            cuts = found.offsets.to_numpy() - found.offsets[0].as_py()
            rows = batch.column("row").to_pylist()
            for k, text in enumerate(_texts(batch.column("text"))):
                groups: dict[tuple[bool, int], list[tuple[int, int]]] = {}
                for i in range(cuts[k], cuts[k + 1]):
                    span = (max(0, places[i] - reach), min(len(text), places[i] + length))
                    groups.setdefault((hots[i], keys[i]), []).append(span)
                for (hot, key), spans in groups.items():
                    for s, e in _merged(spans):
                        if not hot:
                            held.append((key, rows[k], s, text[s:e]))
                            size += e - s
                            continue
                        for a in range(s, e - length + 1, SLICE):
                            b = min(a + SLICE + length - 1, e)
                            w = hasher.every(hasher.sums(np.frombuffer(text[a:b], np.uint8)), length).view(np.int64)
                            n = len(w)
                            yield pa.RecordBatch.from_arrays(
                                [pa.nulls(n, pa.int32()), pa.array([rows[k]] * n, pa.binary()), pa.array(np.arange(a, a + n)),
                                 pa.nulls(n, pa.binary()), pa.array(np.full(n, key)), pa.array(w)], names=names)
                if size >= STEP:
                    yield bodies(held)
                    held, size = [], 0
        if held:
            yield bodies(held)
    return run


_MARK = "row binary, s bigint, e bigint"


def long_matches(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, start, end): runs of bytes under matches of ``length`` or more with another place in the strings."""
    index = rindex.build(strings)
    hit = np.flatnonzero(rindex.matching_statistics(index) >= length)
    sizes = np.array([len(s) for s in strings], np.int64)
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(strings)), sizes)[hit]
    apart = np.ones(len(hit), bool)
    apart[1:] = (hit[1:] != hit[:-1] + 1) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(apart)
    last = np.append(first[1:], len(hit))[:len(first)] - 1
    who = owner[first]
    return who, hit[first] - begins[who], hit[last] + length - begins[who]


def _indexed(length: int):
    def run(table: pa.Table) -> pa.Table:
        who, start, end = long_matches(table.column("body").to_pylist(), length)
        at = pa.array(who)
        base = table.column("start").to_numpy()[who]
        return pa.table({"row": table.column("row").take(at), "s": pa.array(base + start), "e": pa.array(base + end)})
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row``: 128 bits that name a row by its id and text."""
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.col("text"))
    return docs.withColumn("row", F.unhex(F.md5(named.cast("binary"))))


def _settled(anchors: DataFrame, pieces: DataFrame) -> DataFrame:
    """Anchors whose piece occurs twice. A piece that very many anchors have is dealt over several keys; there are fewer than
    HOT_SHARE of them."""
    twice = pieces.where("times > 1").select(F.col("h").alias("_h"), F.col("d").alias("_d"), "times")
    least = max(SALTED_ROWS, math.ceil(anchors.count() / HOT_SHARE))
    salts = F.ceil(F.col("times") / F.lit(SALTED_ROWS)).cast("int")
    hot = twice.where(F.col("times") > least).select(F.col("_h").alias("_hot_h"), F.col("_d").alias("_hot_d"), salts.alias("_salts"))
    every = F.explode(F.sequence(F.lit(0), F.when(F.col("times") > least, salts - 1).otherwise(0)))
    spread = twice.select("_h", "_d", every.alias("_of"))
    found = only_wanted(anchors, twice.select(F.col("_d").alias("d")), "d", exact=False)
    found = found.join(F.broadcast(hot), (F.col("d") == F.col("_hot_d")) & (F.col("h") == F.col("_hot_h")), "left")
    salt = F.coalesce(F.pmod(F.xxhash64("row", "pos"), F.col("_salts")), F.lit(0)).cast("int")
    found = found.select("row", "pos", "h", "d", salt.alias("_salt"))
    return found.join(spread, (F.col("d") == F.col("_d")) & (F.col("h") == F.col("_h")) & (F.col("_salt") == F.col("_of")),
                      "left_semi").select("row", "pos")


def marks(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, s, e): runs of bytes that repeat, which may overlap or reach over the ends, of the texts of ``docs`` (row, text)."""
    reach = length - gram_of(length)
    anchors = stored(docs.select("row", "text").mapInArrow(_anchors(length), _ANCHOR), "anchors")
    again = stored(anchors.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "grams")
    some = only_wanted(anchors, again, "h", exact=False)
    pieces = stored(some.groupBy("h", "d").agg(F.count("*").alias("times"), F.min(F.struct("row", "pos")).alias("at")), "pieces")
    kinds = pieces.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1").select(F.col("h").alias("_h"), "kinds")
    border = stored(pieces.join(kinds, F.col("h") == F.col("_h")).select("h", "at.row", "at.pos", "kinds"), "borders")
    buckets = max(1, math.ceil(border.count() * (length + reach) / BUCKET))
    hot = F.col("kinds") > HOT
    key = F.when(hot, F.col("h")).otherwise(F.pmod(F.xxhash64("h"), F.lit(buckets)))
    wanted = stored(border.groupBy("row").agg(F.collect_list(F.struct("pos", key.alias("key"), hot.alias("hot"))).alias("found")), "wanted")
    number = lambda t: t.withColumn("_row_number", F.xxhash64("row"))
    texts = only_wanted(number(docs.select("row", "text")), number(wanted.select("row")), "_row_number", exact=False)
    texts = texts.select(F.col("row").alias("_row"), "text").join(wanted, F.col("_row") == F.col("row")).select("row", "text", "found")
    regions = stored(texts.mapInArrow(_regions(length), _REGION), "regions")
    inside = regions.where("bucket is not null").select("bucket", "row", "start", "body").groupBy("bucket") \
        .applyInArrow(_indexed(length), _MARK)
    windows = regions.where("bucket is null").select("row", "start", "h", "w")
    twice = windows.groupBy("h", "w").agg(F.count("*").alias("n")).where("n > 1").select("h", "w")
    crowd = windows.join(twice, ["h", "w"], "left_semi").select("row", F.col("start").alias("s"), (F.col("start") + length).alias("e"))
    whole = _settled(anchors, pieces).select("row", (F.col("pos") - reach).alias("s"), (F.col("pos") + length).alias("e"))
    return whole.unionByName(inside).unionByName(crowd)


def _spans(batches):
    """Texts with their marks to maximal runs, clipped to the text."""
    for batch in batches:
        found = batch.column("marks")
        ends = found.offsets.to_numpy() - found.offsets[0].as_py()
        flat = found.flatten()
        s, e = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
        sizes, removed, shas, starts, stops = [], [], [], [], []
        for k, text in enumerate(_texts(batch.column("text"))):
            a, b = np.clip(s[ends[k]:ends[k + 1]], 0, len(text)), np.clip(e[ends[k]:ends[k + 1]], 0, len(text))
            order = np.argsort(a, kind="stable")
            a, b = a[order], np.maximum.accumulate(b[order]) if len(order) else b
            new = np.ones(len(a), bool)
            new[1:] = a[1:] > b[:-1]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(a))[:len(first)] - 1
            from_, to = a[first].tolist(), b[last].tolist()
            sha, at = hashlib.sha256(), 0
            for x, y in zip(from_, to):
                sha.update(text[at:x])
                at = y
            sha.update(text[at:])
            sizes.append(len(text))
            removed.append(sum(to) - sum(from_))
            shas.append(sha.hexdigest())
            starts.append(from_)
            stops.append(to)
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array([len(x) for x in starts], pa.int64()), pa.array(shas, pa.string()), pa.array(starts, longs), pa.array(stops, longs)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"])


_SPANS = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, starts array<bigint>, ends array<bigint>"


def find(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans, kept_sha256, and starts and ends of the removed runs."""
    rows = _keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                              F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    found = marks(rows, length).groupBy("row").agg(F.collect_list(F.struct("s", "e")).alias("marks"))
    found = stored(found.withColumn("_row_number", F.xxhash64("row")), "marks")
    numbered = rows.withColumn("_row_number", F.xxhash64("row"))
    marked = only_wanted(numbered, found, "_row_number").select("doc_id", "text", F.col("row").alias("_row"))
    # rows that only share a number with a marked one have none
    marked = marked.join(found.select("row", "marks"), F.col("_row") == F.col("row"), "left")
    none = F.from_json(F.lit("[]"), "array<struct<s: bigint, e: bigint>>")
    marked = marked.select("doc_id", "text", F.coalesce("marks", none).alias("marks"))
    clean = without(numbered, found, "_row_number").select("doc_id", "text", none.alias("marks"))
    return marked.unionByName(clean).mapInArrow(_spans, _SPANS)
