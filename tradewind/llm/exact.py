"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Each scan task cuts its rows into blocks of at most BLOCK rows, takes a 64-bit fingerprint of every normalised text,
   sorts them and sends each owner (a range of fingerprints) its part, each fingerprint once with a bit that says if the
   block has it twice, Rice-coded: little more than the entropy of the gaps between sorted hashes.
2. An owner decodes what it got, finds the fingerprints that occur twice or more, and answers every block with a bitmap
   over the hashes that the block sent.
3. A block reads the answers beside its own sorted hashes; the rows marked are suspects. Everything else is unique.
4. The texts of suspects alone are shuffled, and grouped by the normalised text itself, so equal means equal byte by
   byte. Partial aggregation leaves one row per text and task, however many copies there are.

Defined results: null is the empty text, and texts of white space only are empty too, so all of them are one group. Of
a group the row with the most code points stays, then the smallest doc_id; a null doc_id comes last. Rows that share a
doc_id and a text are copies like any others; the first of the equal ones (any: they are identical in what counts)
stays. Other columns, whatever their names, are neither read nor changed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.storage import stored
from tradewind.llm.lookup import only_wanted, without

SPACE = b" \t\n\x0b\x0c\r"
BLOCK = 1 << 16
#: About as many rows an owner handles at a time.
OWNED = 1 << 21


def rice_encode(sorted_hashes: np.ndarray) -> bytes:
    """Gaps of ascending uint64 numbers: a header (count, bits of the remainder), unary quotients, plain remainders.
    The Golomb parameter is the power of two next to 0.69 times the mean gap."""
    n = len(sorted_hashes)
    if not n:
        return b""
    gaps = np.diff(sorted_hashes, prepend=np.uint64(0))
    mean = max(1.0, float(sorted_hashes[-1]) / n)
    bits = int(min(63, max(0, round(np.log2(0.69 * mean)))))
    high, low = gaps >> np.uint64(bits), gaps & np.uint64((1 << bits) - 1)
    stops = np.cumsum(high.astype(np.int64) + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 1
    rest = (low[:, None] >> np.arange(bits, dtype=np.uint64)[None, :] & np.uint64(1)).astype(np.uint8)
    return (np.array([n, bits, len(unary)], np.uint32).tobytes() + np.packbits(unary).tobytes()
            + np.packbits(rest.ravel()).tobytes())


def rice_decode(coded: bytes) -> np.ndarray:
    if not coded:
        return np.zeros(0, np.uint64)
    n, bits, length = np.frombuffer(coded, np.uint32, 3).tolist()
    body = np.frombuffer(coded, np.uint8, offset=12)
    cut = (length + 7) // 8
    stops = np.flatnonzero(np.unpackbits(body[:cut], count=length))
    high = np.diff(stops, prepend=-1).astype(np.uint64) - np.uint64(1)
    rest = np.unpackbits(body[cut:], count=n * bits).reshape(n, bits).astype(np.uint64)
    low = (rest << np.arange(bits, dtype=np.uint64)[None, :]).sum(1, dtype=np.uint64)
    return np.cumsum((high << np.uint64(bits)) + low, dtype=np.uint64)


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, SPACE)


_RECORD = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64()), ("text_sha256", pa.string()),
                     ("points", pa.int64())])


def _records(batches):
    """One record per row: its block, its fingerprint, the hash and length that the result shows."""
    part, block, filled = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        shas, points, blocks = [], [], []
        for text in batch.column("text").to_pylist():
            shas.append(hashlib.sha256(normalised(text)).hexdigest())
            points.append(len(text or ""))
            blocks.append((part << 24) + block)
            filled += 1
            if filled == BLOCK:
                block, filled = block + 1, 0
        fps = np.array([int(s[:16], 16) for s in shas], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int64()), batch.column("doc_id").cast(pa.int64()), pa.array(fps), pa.array(shas),
             pa.array(points, pa.int64())], schema=_RECORD)


def _own_hashes(rows: pd.DataFrame) -> np.ndarray:
    return rows["fp"].to_numpy(np.int64).view(np.uint64)


def _send(owners: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hashes, times = np.unique(_own_hashes(rows), return_counts=True)
        at = np.searchsorted(hashes, _starts(owners))
        cuts = np.append(at, len(hashes)).tolist()
        sent = [(key[0], o, rice_encode(hashes[a:b] - _starts(owners)[o]), np.packbits(times[a:b] > 1).tobytes())
                for o, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pd.DataFrame(sent, columns=["block", "owner", "coded", "again"])
    return run


def _starts(owners: int) -> np.ndarray:
    return (np.arange(owners, dtype=np.uint64) * np.uint64((2**64 - 1) // owners)).astype(np.uint64)


def _answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    parts = [rice_decode(c) for c in rows["coded"]]
    values, times = np.unique(np.concatenate(parts), return_counts=True)
    again = [p[np.unpackbits(np.frombuffer(a, np.uint8), count=len(p)).astype(bool)] for p, a in zip(parts, rows["again"], strict=True)]
    twice = np.union1d(values[times > 1], np.concatenate(again))
    answers = []
    for block, own in zip(rows["block"], parts, strict=True):
        hit = np.zeros(len(own), np.uint8)
        if len(twice):
            hit = (twice[np.minimum(np.searchsorted(twice, own), len(twice) - 1)] == own).astype(np.uint8)
        if hit.any():
            answers.append((block, key[0], len(own), np.packbits(hit).tobytes()))
    return pd.DataFrame(answers, columns=["block", "owner", "n", "bits"])


def _mark(owners: int):
    def run(key: tuple, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"doc_id": [], "fp": []})
        hashes, place = np.unique(_own_hashes(rows), return_inverse=True)
        hit = np.zeros(len(hashes), bool)
        begins = np.searchsorted(hashes, _starts(owners))
        for owner, n, bits in zip(answers["owner"], answers["n"], answers["bits"], strict=True):
            at = int(begins[owner])
            hit[at:at + n] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
        return rows[hit[place]][["doc_id", "fp"]]
    return run


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs`` (columns doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    records = stored(docs.mapInArrow(_records, "block bigint, doc_id bigint, fp bigint, text_sha256 string, points bigint"),
                     "fingerprints")
    owners = max(1, -(-records.count() // OWNED))
    sent = records.select("block", "fp").groupBy("block").applyInPandas(
        _send(owners), "block bigint, owner int, coded binary, again binary")
    answers = sent.groupBy("owner").applyInPandas(_answer, "block bigint, owner int, n int, bits binary")
    suspects = stored(records.select("block", "doc_id", "fp").groupBy("block").cogroup(answers.groupBy("block"))
                      .applyInPandas(_mark(owners), "doc_id bigint, fp bigint"), "suspects")
    none = docs.where("doc_id is null")  # rows without an id can't be looked up by it: all of them are suspects
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", "")
    points = F.length(F.coalesce("text", F.lit("")))
    # most code points, then the smallest id, as one number: hash aggregation can keep the largest of numbers
    wide, last = F.expr("18446744073709551616"), F.expr("9223372036854775807")
    rank = points.cast("decimal(10,0)") * wide - F.coalesce(F.col("doc_id"), last).cast("decimal(19,0)")
    texts = only_wanted(docs, suspects).unionByName(none).select(text.alias("text"), rank.cast("decimal(34,0)").alias("rank"))
    groups = texts.groupBy("text").agg(F.max("rank").alias("rank"), F.count("*").alias("group_size"))
    best = F.pmod(-F.col("rank"), wide)
    best = F.when(best > last, best - wide).otherwise(best).cast("bigint")
    groups = stored(groups.select(
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
        F.when(best != last, best).alias("keep_id"), "group_size"), "groups")
    found = records.select("doc_id", "points", "text_sha256").join(groups, "text_sha256", "left")
    alone = F.col("group_size").isNull()
    return found.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256")


def drop(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts: the one that ``find`` keeps. All columns stay as they are.
    Rows that repeat both id and text become one row; rows without an id can't be told apart and all stay."""
    found = stored(find(docs), "copies")
    lost = found.where(~F.col("kept")).select("doc_id")
    again = found.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    again = stored(again, "repeated-ids")
    rest = without(docs, lost.unionByName(again))
    sha = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", "").cast("binary"), 256)
    kept = found.where("kept").join(again, "doc_id", "left_semi").select(
        F.col("doc_id").alias("_copy_id"), F.col("text_sha256").alias("_kept_sha")).distinct()
    repeated = only_wanted(docs, again).withColumn("_copy_sha", sha).dropDuplicates(["doc_id", "_copy_sha"])
    repeated = repeated.join(kept, (F.col("doc_id") == F.col("_copy_id")) & (F.col("_copy_sha") == F.col("_kept_sha")), "left_semi")
    return rest.unionByName(repeated.select(*docs.columns))
