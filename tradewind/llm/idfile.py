"""Token-id files: documents tokenized, coded block by block in id order, and read back.

A file set is a Parquet folder with one row per block: (shard, block, documents, ids, coded). Shards are ranges of
doc_id, so shard and block order is id order; ``coded`` is a block of ``codec``, which any task can read alone. A block
closes at BLOCK ids; a longer document has one for itself.

Defined results: null and empty texts are the end id alone; null ids come first; rows that share an id are written in
the order of their texts' hashes; an empty table gives no blocks. Columns other than doc_id and text are not written.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm import codec
from tradewind.llm.tokens import encoder, public_path
from tradewind.llm.words import small

VOCABULARY = "word_bpe_49k.json"
END = 1
BLOCK = 1 << 20
#: Rows whose texts are cut into chunks together.
ROWS = 4096
_SCHEMA = "shard int, block int, documents bigint, ids bigint, coded binary"


def _blocks(vocabulary: str, end: int, size: int):
    def run(batches):
        shard, block, held, docs, n = TaskContext.get().partitionId(), 0, [], [], 0

        def close():
            coded = codec.encode(np.array(docs, np.int64), np.array([len(x) for x in held], np.int64), np.concatenate(held))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([len(docs)], pa.int64()),
                 pa.array([n], pa.int64()), pa.array([coded], pa.binary())], names=["shard", "block", "documents", "ids", "coded"])

        coder = encoder(vocabulary)
        for batch in small(batches, ROWS):
            texts = coder.encode_many(batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = np.append(ids, np.uint32(end))
                if n and n + len(ids) > size:
                    yield close()
                    block, held, docs, n = block + 1, [], [], 0
                held.append(ids)
                docs.append(codec.NO_ID if doc_id is None else doc_id)
                n += len(ids)
        if docs:
            yield close()
    return run


def write(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = END, block: int = BLOCK) -> None:
    """Write the ids of all texts of ``docs`` (doc_id, text) under ``path``, in ascending doc_id order."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h").select("doc_id", "text")
    ordered.mapInArrow(_blocks(vocabulary or public_path(VOCABULARY), end, block), _SCHEMA).write.parquet(path)


def _read(batches):
    for batch in batches:
        for shard, block, coded in zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "coded")), strict=True):
            doc_ids, lengths, ids = codec.decode(coded)
            ends = np.cumsum(lengths)
            raw = ids.astype("<u4")
            sums = [zlib.crc32(raw[e - n:e].tobytes()) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(doc_ids), pa.int32()), pa.array([block] * len(doc_ids), pa.int32()),
                 pa.array(doc_ids, pa.int64(), mask=doc_ids == codec.NO_ID), pa.array(ends - lengths, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                names=["shard", "block", "doc_id", "inside", "n_tokens", "ids_crc32"])


def _read_ids(batches):
    for batch in batches:
        for coded in batch.column("coded").to_pylist():
            doc_ids, lengths, ids = codec.decode(coded)
            parts = np.split(ids.astype(np.int64), np.cumsum(lengths)[:-1]) if len(lengths) else []
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64(), mask=doc_ids == codec.NO_ID),
                                              pa.array([p.tolist() for p in parts], pa.list_(pa.int64()))], names=["doc_id", "ids"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of every document written under ``path``."""
    return spark.read.schema(_SCHEMA).parquet(path).select("coded").mapInArrow(_read_ids, "doc_id bigint, ids array<bigint>")


def index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the decoded ids; start counts the ids of all documents before. Running
    sums go over the blocks of one shard, and over one row per shard."""
    table = spark.read.schema(_SCHEMA).parquet(path)
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    shards = table.groupBy("shard").agg(F.sum("ids").alias("ids")).select(
        F.col("shard").alias("_shard"), F.coalesce(F.sum("ids").over(before(F.lit(0), "shard")), F.lit(0)).alias("base"))
    blocks = table.select("shard", "block", F.coalesce(F.sum("ids").over(before("shard", "block")), F.lit(0)).alias("past"))
    blocks = blocks.join(shards, F.col("shard") == F.col("_shard")).select(
        F.col("shard").alias("_shard"), F.col("block").alias("_block"), (F.col("base") + F.col("past")).alias("past"))
    rows = table.select("shard", "block", "coded").mapInArrow(
        _read, "shard int, block int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(blocks, (F.col("shard") == F.col("_shard")) & (F.col("block") == F.col("_block"))).select(
        "doc_id", (F.col("past") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
